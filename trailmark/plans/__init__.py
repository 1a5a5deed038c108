"""Whole jobs built from the operators: runs, reports, explanations."""
