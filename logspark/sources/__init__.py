"""Readers: event topics, log directories and dimension files."""
