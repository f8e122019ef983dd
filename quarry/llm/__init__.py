"""Operators of a training-data pipeline (text, pages, labels, embeddings).

Nothing outside this package imports it. ``registry`` holds the queries.
"""
