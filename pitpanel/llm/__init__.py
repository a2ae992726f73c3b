"""Training-data operators: archives, filters, de-duplication, tokenised output (see README)."""
