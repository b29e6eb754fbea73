"""Corpus operators for training-data preparation.

Operators over tables of documents, web pages and vectors. Nothing else in the
library imports this subpackage; its queries are registered only when it can
be imported.
"""
