"""Readers: text formats -> DataFrames with typed columns."""
