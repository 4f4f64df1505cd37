"""Transformers, estimators and table operators."""
