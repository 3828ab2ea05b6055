"""Operators for building training corpora: search, near duplicates, packing, sharding, filtering, mixing."""
