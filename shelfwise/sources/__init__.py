"""Sources and sinks: comma text with quarantine, keyed Parquet tables."""
