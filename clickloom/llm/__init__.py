"""Operators for training-data pipelines: text and vector tables in, DataFrames out."""
