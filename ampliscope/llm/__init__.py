"""Training-data operators: language ID, filters, dedup, mixing, packing, search."""
