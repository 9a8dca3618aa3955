"""Column functions: slots, JSON lines, delimited text."""
