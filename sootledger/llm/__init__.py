"""Operators for preparing training data: quality, mixing, de-duplication, sharding, tokens, packing."""
