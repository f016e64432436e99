"""Runnable catalogue: domain views over the test tables, queries and their SQL twins."""
