"""End-of-day price history on Spark: clean, adjust, track membership, serve."""
