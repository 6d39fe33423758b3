"""Operators on pixel tables (row, col, values) and object tables."""
