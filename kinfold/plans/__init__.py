"""Jobs that put the operators together."""
