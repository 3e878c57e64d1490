"""Training-data operators: quality, LM scores, near-duplicates, sharding, decontamination, archives, tokens, mixing, licences, neighbours."""
