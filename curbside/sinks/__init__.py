"""Writers: fixed-size partitioned Parquet, format matrix, Kafka."""
