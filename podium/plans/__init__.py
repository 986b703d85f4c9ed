"""The models: each takes DataFrames and returns a DataFrame."""
