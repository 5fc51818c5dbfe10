"""Building blocks: each is a function from DataFrames to DataFrames."""
