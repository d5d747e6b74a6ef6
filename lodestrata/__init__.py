"""Layered (raw, clean, integrated, analytic) tables from batch records and event streams, on Spark."""

__version__ = "0.1.0"
