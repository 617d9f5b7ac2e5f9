"""Evidence analytics on Spark: typed slices, linked facts, positions and checks."""
