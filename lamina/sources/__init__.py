"""Opening, scanning and writing Parquet files."""
