"""Operators of a training-data pipeline over web-scale document tables.

Nothing outside this folder imports it; `queries.py` binds the operators to the
driver's tables.
"""
