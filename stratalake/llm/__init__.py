"""Operators of a training-data pipeline: documents, pages, conversations, vectors.

Nothing outside this subpackage imports it; ``queries.py`` registers one query
per operator and ``corpus_pipeline.py`` chains five of them.
"""
