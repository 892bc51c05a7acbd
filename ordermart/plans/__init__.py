"""Jobs that chain operators and write tables."""
