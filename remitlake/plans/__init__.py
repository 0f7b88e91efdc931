"""The daily jobs."""
