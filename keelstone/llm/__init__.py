"""Training-data operators: deduplication, classification, sharding, mixing and tokenisation."""
