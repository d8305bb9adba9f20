"""Operators for preparing language-model training text, and their queries.

Nothing else in the library imports this subpackage.
"""
