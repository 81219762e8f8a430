"""Sources: bronze text, parquet tables, dimensions and the fixture adapters
that derive payment events from the driver's ``events`` table."""
