"""Training-data operators: deduplication, scans, media, tokens, packing, quality and chat."""
