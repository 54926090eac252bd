"""Operators of a training-data pipeline, built on documents and embeddings."""
