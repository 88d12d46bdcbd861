"""contentflow.sources."""
