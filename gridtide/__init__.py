"""Spark jobs for wide time-series tables: staging, features, marts, metric rules."""
