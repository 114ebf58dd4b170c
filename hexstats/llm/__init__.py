"""Operators for training-data pipelines: near-duplicates, filters, classifiers, tokens, mixing."""
