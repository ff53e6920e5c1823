"""filmloom.operators."""
