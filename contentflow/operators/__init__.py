"""contentflow.operators."""
