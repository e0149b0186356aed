"""Warehouse jobs: each is a function of DataFrames and a business date."""
