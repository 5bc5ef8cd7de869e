"""Training-data operators: scoring, filtering, deduplication, mixing, search, tokens, extraction."""
