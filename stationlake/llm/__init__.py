"""Training-data operators: filters, dedup, classifiers, search, mixing, packing."""
