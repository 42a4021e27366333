"""The rollups and warehouse jobs, composed from operators."""
