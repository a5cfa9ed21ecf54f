"""Operators of a training-data pipeline (documents, pages, embeddings)."""
