"""contentflow.plans."""
