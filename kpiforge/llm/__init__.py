"""Training-data operators: search, language, sharding, mixing, near-duplicates,
decontamination, personal data, web archives, line deduplication, toxicity."""
