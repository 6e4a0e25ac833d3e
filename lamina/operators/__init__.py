"""Batches, metadata relations and checks over Parquet files."""
