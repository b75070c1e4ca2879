"""Operators for large training corpora: filters, de-duplication, decontamination, search, tokens, models."""
