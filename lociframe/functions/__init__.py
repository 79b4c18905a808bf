"""Part of lociframe."""
