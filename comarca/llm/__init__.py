"""Operators of a training-data pipeline: filters, deduplication, tokenising, packing, retrieval.

Nothing outside this folder (but the top-level ``corpus_pipeline.py``) imports it.
"""
