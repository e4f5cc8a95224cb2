"""Input sources: the staging table, the fixture adapter and the seed tables."""
