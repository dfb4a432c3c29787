"""Message sources, lake tables, and inputs derived from the given tables."""
