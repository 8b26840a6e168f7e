"""Whole jobs: the batch from files to gold tables, and the queries over the test tables."""
