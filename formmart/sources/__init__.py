"""Sources and sinks: raw text files, the driver's parquet tables, written tables."""
