"""Named queries over the given tables, with SQL that states the same result."""
