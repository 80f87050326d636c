"""Operators for building training corpora: near duplicates, tokens, packing, scoring, search."""
