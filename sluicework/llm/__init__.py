"""Operators a large-scale training-data pipeline needs.

Each module holds one operator with a general interface; ``catalog`` applies
them to the standard tables.  Nothing outside this folder imports it.
"""
