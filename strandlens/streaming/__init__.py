"""Incremental forms of the operators that allow it."""
