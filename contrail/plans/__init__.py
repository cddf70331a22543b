"""Whole queries: the feature table, jobs, and the registry of queries over the test tables."""
