"""Operators for building training corpora: deduplication, filtering, tokenizing, rendering."""
