"""Training-data operators: deduplication, safety, tokens, formatting and packing."""
