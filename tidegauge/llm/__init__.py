"""Operators of a training-data pipeline: text, pages, vectors. Nothing outside this folder imports it."""
