"""Change capture and incremental runs as streams."""
