"""Operators for training-data corpora (deduplication, mixing, tokenising, extraction, filtering).

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it;
``__spark_entry__.py`` registers its queries only when it is present.
"""
