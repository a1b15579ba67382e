"""Operators that prepare documents, conversations and vectors for model training."""
