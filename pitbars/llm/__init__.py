"""Operators for preparing training data: tokens, copies, filters, packing and search."""
