"""Table builders: DataFrames in, one DataFrame out."""
