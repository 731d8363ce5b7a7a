"""Vellumflow: document analytics expressed as Spark DataFrames."""
