"""Writing layers: Parquet, one folder per load, read by others only once it is published whole."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from lodestrata.contracts import LOAD, partition_columns
from lodestrata.functions.lineage import load_name, load_parts
from lodestrata.sources.manifest import exists, publish

#: One writing of a load. A load that is written again gets another one beside the first.
LOT = "lote"


def write_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], rebalance: bool = False, replace_all: bool = False
) -> str:
    """Overwrites the partitions present in ``df``; with ``replace_all`` the whole table.

    ``rebalance`` shuffles by the partition columns first, splitting large partitions and joining
    small ones: fewer files, at the price of one exchange.
    """
    if rebalance:
        df = df.hint("rebalance", *partitions)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partitions)
        .parquet(path)
    )
    return path


def stage_layer(
    df: DataFrame, path: str, entity: str, layer: str, run_ts: datetime, rebalance: bool = True, routes: Sequence[str] = ()
) -> str:
    """Writes one load of a table into a folder of its own, with the partitions the layer needs; returns the folder.

    Nobody reads it before ``publish_load``. ``routes`` are columns to part the rows by first, for loads whose rows go to several tables.
    """
    layout = [name for name in partition_columns(entity, layer) if name != LOAD]
    parts = load_parts(run_ts, with_year="ano" in layout)
    added = {name: value for name, value in parts.items() if name in layout and name not in df.columns}
    rows = df.drop(LOAD).withColumns(added)
    folder = f"{path}/{LOAD}={load_name(run_ts)}/{LOT}={uuid.uuid4().hex}"
    return write_partitions(rows, folder, [*routes, *layout], rebalance, replace_all=True)


def publish_load(spark: SparkSession, path: str, run_ts: datetime, folder: str) -> None:
    """Makes a folder the load of its day, in place of whatever that was. A folder that a routed write did not make is a load without rows."""
    inside = folder.removeprefix(f"{path}/")
    publish(spark, path, {load_name(run_ts): inside if exists(spark, folder) else None})


def write_layer(df: DataFrame, path: str, entity: str, layer: str, run_ts: datetime, rebalance: bool = True) -> str:
    """Stores and publishes one load of a table.

    What the load of the day held goes, also where the new rows lack its partitions, or where there are no new rows. It stays until the next
    publication if the write fails, and is deleted by the one after.
    """
    publish_load(df.sparkSession, path, run_ts, stage_layer(df, path, entity, layer, run_ts, rebalance))
    return path
