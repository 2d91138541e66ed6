"""Readers that turn files and service answers into DataFrames."""
