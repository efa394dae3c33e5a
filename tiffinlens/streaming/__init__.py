"""The change-feed derivations and the daily view as Structured Streaming jobs."""
