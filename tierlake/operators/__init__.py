"""DataFrame operators: deduplication, unnesting, cleaning, marts and audits."""
