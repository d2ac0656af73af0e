"""Training-data operators: the ten dealt operators and their pipeline.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  Each
module is one operator with its own general interface; ``queries.py`` holds
the thin registered queries that derive the contract's columns.
"""
