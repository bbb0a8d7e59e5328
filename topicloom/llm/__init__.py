"""Operators for preparing training data: text in, text or decisions out."""
