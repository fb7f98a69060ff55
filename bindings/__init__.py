"""Operators bound to the given tables: each query beside the SQL that must give its result."""
