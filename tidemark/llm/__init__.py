"""Training-data operators: language ID, token files, dedup, joins, scoring, mixing.

Nothing else in the library imports this subpackage; it may be removed as a
whole (with ``corpus_pipeline.py`` and ``tests/llm``).
"""
