"""Operators for training-data corpora: language, quality, copies, licences, mixing, packing.

Each module is one operator with its own interface; ``queries`` registers the
thin queries that apply them to the given tables.  Nothing else in the library
imports this package.
"""
