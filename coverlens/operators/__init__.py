"""Table-to-table operators: lookups, dedup, facets, audits."""
