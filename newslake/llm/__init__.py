"""Training-data operators: deduplication, scoring, mixing, formatting, search, encoding."""
