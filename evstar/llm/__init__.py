"""Operators for preparing language-model training data.

Ten operators, one module each, and the modules that register their queries.
Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
