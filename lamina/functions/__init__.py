"""Column expressions of the read plan's converters, and geospatial functions."""
