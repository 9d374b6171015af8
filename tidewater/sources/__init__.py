"""Sources and sinks: parquet tables, CSV, landed monitoring JSON, reports, models."""
