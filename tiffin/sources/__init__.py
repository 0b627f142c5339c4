"""Inputs and outputs: CSV extracts and the layered Parquet warehouse."""
