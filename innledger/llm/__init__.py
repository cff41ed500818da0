"""Operators that prepare documents, pages and embeddings for model training."""
