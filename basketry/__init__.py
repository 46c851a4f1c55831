"""Commerce analytics as plain PySpark jobs: every job is a function from DataFrames to a DataFrame."""
