"""Training-data operators: filtering, deduplication, decontamination, formatting and mixing at scale."""
