"""Reading landed documents, keyed tables, published tables."""
