"""DataFrame operators: quality flags, deduplication, lookups, completeness."""
