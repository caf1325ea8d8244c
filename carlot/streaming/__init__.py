"""Incremental loading of landed pages."""
