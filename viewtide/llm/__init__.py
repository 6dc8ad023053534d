"""Training-data operators: quality, sharding, scoring, privacy, packing, text."""
