"""Operators for text corpora. Nothing outside this folder imports it; the queries are in ``registry``."""
