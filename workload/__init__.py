"""Registered queries over the given tables, and the SQL each one is checked against."""

from importlib import import_module

QUERY_MODULES = [import_module(f"workload.{name}") for name in ("q_columns", "q_tables", "q_gold", "q_storage", "q_quality", "q_stream", "q_jobs")]
