"""Splitting, fitting, scoring and explaining failure-risk models."""
