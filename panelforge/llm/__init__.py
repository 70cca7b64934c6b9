"""Training-data pipeline operators: language, quality, shards, scoring, packing, URLs, token files, duplicates."""
