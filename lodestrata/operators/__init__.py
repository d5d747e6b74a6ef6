"""Operators on whole tables: DataFrames in, DataFrames out."""
