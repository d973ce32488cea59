"""DataFrame -> DataFrame operators of the warehouse (no I/O here)."""
