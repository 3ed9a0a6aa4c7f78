"""Operators for training-data pipelines (token files, deduplication,
tokenisation, language and toxicity models, WARC, vector search).

Nothing else in the library imports this subpackage.  Every operator is a
function over DataFrames; ``queries.py`` holds the thin registered queries.
"""
