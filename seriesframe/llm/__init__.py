"""Training-data operators: deduplication, tokenisation, filtering, packing and extraction over text tables."""
