"""Operators that combine, group, rank or score whole frames."""
