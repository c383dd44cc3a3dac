"""Whole jobs: the batch fan-out, and every operator as a named query over the given tables."""
