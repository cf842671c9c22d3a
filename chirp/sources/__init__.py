"""Sources and sinks: nested JSON tweets, tab-separated archives, Parquet
and catalog tables."""
