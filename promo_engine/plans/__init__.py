"""Split windows and end-to-end jobs."""
