"""Relational operators on DataFrames: filters, rollups, joins and nesting."""
