"""Operators of a training-data pipeline over text and page tables.

Nothing outside this subpackage imports it. Each operator is a module; ``catalog`` holds
the registered queries.
"""
