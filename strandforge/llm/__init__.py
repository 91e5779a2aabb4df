"""Operators of a training-data pipeline over documents and web pages.

Nothing else in the package imports this subpackage; it can be deleted as a whole.
"""
