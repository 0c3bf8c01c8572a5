"""Sources, landing and stored tables."""
