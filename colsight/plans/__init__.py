"""Whole jobs built from the operators: table profile, column typing, vocabulary mining."""
