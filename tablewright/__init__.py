"""Move, sample, discover, mask and generate tabular data with Spark."""
