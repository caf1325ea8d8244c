"""Spark operators and ML jobs over second-hand vehicle listings."""
