"""Sources and sinks: raw CSV batches, partitioned Parquet, stored tables."""
