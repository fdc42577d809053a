"""Readers of published sources, all landing as DataFrames with declared schemas."""
