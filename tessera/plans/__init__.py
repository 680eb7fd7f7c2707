"""Pipelines composed from the operators (retail, quotes, text, sales, synthetic data, ML)."""
