"""The tables and reports themselves, as functions from DataFrames to DataFrames."""
