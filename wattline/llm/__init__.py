"""Operators for training-data pipelines (text, embeddings, conversations)."""
