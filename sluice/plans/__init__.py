"""Whole plans: the quality chain and the jobs built from it."""
