"""Incremental refresh of the fact table from a folder that fills up."""
