"""Reading, landing and publishing tables."""
