"""Training-data operators: near-duplicates, quality, search, URL rules, mixing and counts."""
