"""Whole jobs: fitting, scoring, evaluating and comparing models."""
