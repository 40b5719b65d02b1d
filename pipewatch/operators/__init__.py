"""Skew-proof building blocks: running sums, ranks, quantiles."""
