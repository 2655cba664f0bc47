"""Corpus operators for training-data pipelines.

Nothing else in the library imports this subpackage. Every operator takes the
columns it names, ignores all others, and states in its docstring what it does
with nulls, empty and very long texts, ties, repeated rows and empty tables.
"""
