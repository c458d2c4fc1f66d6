"""Operators for preparing training text.

Each module holds one operator over a table of texts; ``queries`` applies them to
the driver's tables. Nothing outside this package imports it.
"""
