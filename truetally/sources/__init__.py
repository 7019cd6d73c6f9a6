"""Inputs: parquet reads, fixed reference data and the driver-table adapter."""
