"""Operators for training data: documents, pages, conversations."""
