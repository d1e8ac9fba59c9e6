"""DataFrames into files."""
