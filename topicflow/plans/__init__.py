"""Jobs, lookups, and the registered queries with their SQL."""
