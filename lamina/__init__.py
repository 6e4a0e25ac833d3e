"""A PySpark-native toolkit for Parquet files: typed scans, plans, metadata, writes."""
