"""Operators of a training-data pipeline over documents, pages and embeddings.

One module per operator; ``queries`` registers them. Nothing else in the
library imports this package.
"""
