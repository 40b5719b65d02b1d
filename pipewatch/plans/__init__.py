"""Whole computations: features, root causes, reports, publishing."""
