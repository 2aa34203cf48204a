"""Training-data operators: filtering, deduplication, packing, scoring and search on Spark."""
