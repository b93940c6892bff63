"""Operators for training-data pipelines, their queries and the SQL each must equal."""
