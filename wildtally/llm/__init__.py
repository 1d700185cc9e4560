"""Operators for preparing training text: methods over documents, pages, conversations, embeddings and a benchmark.

Nothing else in the library imports this subpackage.
"""
