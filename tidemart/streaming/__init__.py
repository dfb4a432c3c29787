"""The streaming jobs."""
