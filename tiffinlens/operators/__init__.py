"""Operators: pure DataFrame-in, DataFrame-out functions, one module per subject."""
