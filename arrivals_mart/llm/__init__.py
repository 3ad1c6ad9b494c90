"""Training-data operators: quality, tokens, secrets, duplicates, mixing, toxicity, neighbours, archives."""
