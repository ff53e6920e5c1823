"""filmloom.streaming."""
