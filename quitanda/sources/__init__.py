"""Sources and sinks: fixture mapping, CSV/seed, JDBC, Parquet landing, raw load."""
