"""Operators of a training-data pipeline: filtering, deduplication, packing, sharding, formatting.

Each module holds one operator. ``queries`` binds them to the test tables and
``oracle`` states the results of those that SQL can express. Nothing outside
this subpackage (and ``corpus_pipeline`` at the top) imports it.
"""
