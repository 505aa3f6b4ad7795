"""Training-data operators: text scoring, deduplication, filtering, packing."""
