"""Operators for building training corpora: extraction, mixing, joins, filters, scoring, tokens."""
