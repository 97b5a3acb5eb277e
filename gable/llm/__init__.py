"""Training-data operators: quality, privacy, decontamination, near duplicates, tokens, language models."""
