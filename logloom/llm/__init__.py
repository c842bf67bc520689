"""Operators for training data: filters, near duplicates, mixing and tokenizers over documents, vectors and pages."""
