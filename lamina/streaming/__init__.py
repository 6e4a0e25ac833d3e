"""The read plan applied to files as they arrive."""
