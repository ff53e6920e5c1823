"""filmloom.sources."""
