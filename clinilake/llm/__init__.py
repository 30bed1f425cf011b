"""Operators for preparing training text, one module each, plus their queries.

Nothing else in the library imports this subpackage.
"""
