"""Training-data operators: deduplication, filtering, mixing and tokenising of a text corpus."""
