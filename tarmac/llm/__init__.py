"""Operators of a training-data pipeline: dedup, search, scoring, tokenizing, mixing.

Nothing outside this package imports it.  ``queries.py`` registers the
``opN_*`` queries, ``corpus_pipeline.py`` at the repository top chains five
of the operators.
"""
