"""Files into DataFrames."""
