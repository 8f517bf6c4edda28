"""Training-data operators: dedup, sharding, mixing, tokenizing, scoring, fingerprints."""
