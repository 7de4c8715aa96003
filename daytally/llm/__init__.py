"""Operators for training-data pipelines: language id, deduplication, filters, packing.

Each module holds one operator with its own general interface; ``queries`` binds them to
the provided tables.  Nothing outside this folder imports it.
"""
