"""Keeping one row per key.

``row_number() == 1`` is planned by Spark with a group limit on the map side, so each task sends at
most one row per key to the shuffle, however many rows share a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_row_in_key"


def total_order(df: DataFrame, keys: Sequence[str], first: Sequence[Column] = ()) -> list[Column]:
    """``first``, then every other column, so that rows that tie are equal in all columns."""
    rest = [name for name in df.columns if name not in keys]
    return [*first, *(F.col(name).asc_nulls_last() for name in rest)]


def first_per_key(df: DataFrame, keys: Sequence[str], first: Sequence[Column] = ()) -> DataFrame:
    """One row per key (null counts as a value), the first by ``first`` and then by all columns."""
    order = total_order(df, keys, first) or [F.lit(1)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(window)).where(F.col(_RN) == 1).drop(_RN)


def latest_per_key(df: DataFrame, keys: Sequence[str], time_column: str) -> DataFrame:
    return first_per_key(df, keys, [F.col(time_column).desc_nulls_last()])


def latest_snapshot(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest load of each key, where loads pile up as full snapshots."""
    return latest_per_key(df, keys, "_ingestion_timestamp")


def distinct_lookup(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def mark_repeats(df: DataFrame, key: str, flag: str, first: Sequence[Column] = ()) -> DataFrame:
    """Adds ``flag``: true for every row of a key but one.

    All rows stay, so a hot key cannot be cut down before the shuffle. Rows are numbered in two
    steps instead: within (key, input partition), then only the winners of each partition against
    each other. The partition number is a salt that a retried task reproduces, unlike a random one.
    """
    order = total_order(df, [key], first) or [F.lit(1)]
    local, salt = "_row_in_part", "_part"
    in_part = Window.partitionBy(key, salt).orderBy(*order)
    # Winners share group -1; every other row stays in the group of its own partition.
    across = Window.partitionBy(key, "_round").orderBy(*order)
    marked = (
        df.withColumn(salt, F.spark_partition_id())
        .withColumn(local, F.row_number().over(in_part))
        .withColumn("_round", F.when(F.col(local) == 1, F.lit(-1)).otherwise(F.col(salt)))
        .withColumn(_RN, F.row_number().over(across))
        .withColumn(flag, (F.col("_round") >= 0) | (F.col(_RN) > 1))
    )
    return marked.drop(salt, local, "_round", _RN)
