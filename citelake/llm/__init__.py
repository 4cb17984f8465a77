"""Operators of a training-data pipeline over tables of documents, pages and conversations.

Each module holds one operator with its general interface; ``registered`` holds the thin queries
over the given tables. Nothing outside this package imports it.
"""
