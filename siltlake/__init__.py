"""siltlake: streams of JSON events into query-ready, partitioned Parquet, expressed in Spark."""
