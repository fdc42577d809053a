"""Training-data operators: quality, tokenisation, near-duplicates, packing."""
