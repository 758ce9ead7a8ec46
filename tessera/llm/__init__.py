"""Operators for preparing training text.

One module per operator; ``queries`` binds them to the test tables. Nothing
outside this package (and ``corpus_pipeline.py``) imports it.
"""
