"""Column functions: every one takes and returns Columns, with no Python in the row path."""
