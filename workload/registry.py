"""The register of queries: name, Spark function, checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.data import Data
from workload.oracle import oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The checking SELECTs as written, for queries over the results of others.
SELECTS: dict[str, str] = {}


def query(sql: str):
    """Registers a function of ``Data`` under its name, with the SELECT it must agree with."""

    def register(build: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
        QUERIES[build.__name__] = lambda spark, sf_dir: build(Data(spark, sf_dir))
        ORACLES[build.__name__] = oracle(sql)
        SELECTS[build.__name__] = sql
        return build

    return register
