"""Incremental data-mart loading on Spark DataFrames."""
