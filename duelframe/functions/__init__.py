"""Column functions: each takes and returns Columns, all built in, none in Python."""
