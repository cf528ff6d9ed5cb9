"""Whole plans: the batch job, and every operator as a named query."""
