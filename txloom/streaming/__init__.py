"""Incremental jobs over stored state."""
