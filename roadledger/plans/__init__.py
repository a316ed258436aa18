"""Jobs composed from the operators: score refresh, compaction, catalog, table queries."""
