"""Jobs over a warehouse root: bronze ingest, silver and gold runs, queries."""
