"""Operators for preparing language-model training data; nothing else in the library imports this subpackage.

Every operator takes a DataFrame and column names and returns a DataFrame; ``catalog`` holds the thin queries.
"""
