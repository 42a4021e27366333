"""Input schemas and table storage."""
