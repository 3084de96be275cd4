"""Structured Streaming jobs and the versioned registry snapshots they share."""
