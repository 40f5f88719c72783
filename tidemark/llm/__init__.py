"""Operators for training-data pipelines: tokens, languages, quality, duplicates, shards.

Nothing outside this package imports it. ``queries`` registers one query per
operator; ``corpus_pipeline.py`` at the top of the repository chains five.
"""
