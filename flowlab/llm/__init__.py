"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing outside this subpackage imports it; its queries are in ``queries.py``.
"""
