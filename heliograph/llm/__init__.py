"""Training-data operators on Spark: search, deduplication, mixing, quality, safety, tokens, HTML."""
