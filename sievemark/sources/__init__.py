"""Batch files in, tables out."""
