"""Operators for preparing training data: text, web archives, tokens and vectors."""
