"""Writers: topics, archives, dated indexes and snapshots."""
