"""Spark-first feature tables, network analysis and map generalization."""
