"""Operators for training-data pipelines.

Nothing outside this subpackage (besides the guarded hook in ``__spark_entry__.py``) imports it.
"""
