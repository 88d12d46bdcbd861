"""contentflow.functions."""
