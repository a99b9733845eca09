"""Structured Streaming jobs.  The transformations also run on batch frames."""
