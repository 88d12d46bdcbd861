"""contentflow.streaming."""
