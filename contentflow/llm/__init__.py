"""Operators of a training-data pipeline (dedup, mixing, tokens, chat, scans).

Nothing outside this folder imports it, except ``corpus_pipeline.py``.
"""
