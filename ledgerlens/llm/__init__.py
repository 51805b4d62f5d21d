"""Operators for large-scale training-data preparation.

Ten operators over ``documents`` / ``pages`` and the pipeline stages built
from them. Nothing outside this package imports it; the queries live in
``queries.py``.
"""
