"""filmloom.functions."""
