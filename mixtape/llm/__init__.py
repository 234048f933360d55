"""Operators of a training-data pipeline over document tables.

Each module holds one operator with its own general interface; ``queries``
registers a thin ``opN_<name>`` query for each. Nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it.
"""
