"""Boosted-tree models per horizon, on Spark ML."""
