"""Operators for preparing training data from the documents, conversations and benchmark tables."""
