"""Reading sources and keeping tables."""
