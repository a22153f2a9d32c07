"""Training-data operators: URL filter, quality, search, dedup, decontamination, PII, secrets, packing, token files."""
