"""Whole jobs built from the operators, and the registry of queries."""
