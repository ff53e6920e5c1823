"""filmloom.plans."""
