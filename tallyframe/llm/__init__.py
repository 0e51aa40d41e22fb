"""Operators of a training-data pipeline over documents, embeddings and labels."""
