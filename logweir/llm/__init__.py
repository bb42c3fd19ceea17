"""Operators on documents, embeddings and pages for preparing training data."""
