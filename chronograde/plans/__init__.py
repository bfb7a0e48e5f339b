"""Whole-batch plans composed from the operators, and the query catalogue."""
