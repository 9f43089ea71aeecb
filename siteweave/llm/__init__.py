"""Training-data operators: search, extraction, tokenising, deduplication, mixing, safety."""
