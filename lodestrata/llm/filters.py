"""A filter of fixed size that tells, before a join, which rows can't meet a partner."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a filter. One that is full costs rows that the join then drops, not results.
FILTER_BITS = 1 << 25
_U = np.uint64


def filter_of(keys: DataFrame) -> np.ndarray:
    """A filter over a column ``key`` of hashes, put together by Spark; at most FILTER_BITS / 64 rows come to the driver."""
    places = F.explode(F.array(F.col("key").bitwiseAND(FILTER_BITS - 1), F.shiftrightunsigned("key", 31).bitwiseAND(FILTER_BITS - 1)))
    rows = keys.select(places.alias("p")).select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, CAST(p & 63 AS INT))").alias("bit"))
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bits.view(_U)


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys a filter may hold; its bits are a power of two in number."""
    k, mask = keys.view(_U), _U(64 * len(bits) - 1)
    out = np.zeros(len(k), dtype=bool)
    place = k & mask
    on = np.flatnonzero((bits[place >> _U(6)] >> (place & _U(63))) & _U(1))
    place = (k[on] >> _U(31)) & mask
    out[on] = (bits[place >> _U(6)] >> (place & _U(63))) & _U(1) == 1
    return out


def maybe_in(spark: SparkSession, keys: DataFrame) -> Callable[[Column], Column]:
    """A condition on a column of hashes: false only where the value is surely not among ``keys`` (its column ``key``)."""
    bits = spark.sparkContext.broadcast(filter_of(keys))

    @F.pandas_udf("boolean")
    def maybe(values: pd.Series) -> pd.Series:
        return pd.Series(in_filter(bits.value, values.to_numpy(np.int64)))

    return maybe
