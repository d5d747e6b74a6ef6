"""Lineage columns, row fingerprints and load-date partitions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.contracts import DIRECTORY_ENTITIES, EVENT_ENTITY, LINEAGE, struct_of

# Job labels and source types
BATCH_JOB = "etl-bronze-batch"
STREAM_JOB = "etl-bronze-streaming"
BATCH_SOURCE = "batch"
STREAM_SOURCE = "streaming"

TECHNICAL_COLUMNS = (*struct_of(LINEAGE["bronze"]).fieldNames(), "_source_type")


def fingerprint(columns: Sequence[str]) -> Column:
    """md5 over the text of the columns in order; names that start with ``_`` do not count."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns if not c.startswith("_")]
    return F.md5(F.concat_ws("|", *texts))


def load_name(run_ts: datetime) -> str:
    """The full date of a load, which names its folder."""
    return f"{run_ts:%Y-%m-%d}"


def load_parts(run_ts: datetime, with_year: bool) -> dict[str, Column]:
    """Partition values of one load as zero-padded text."""
    parts = {"ano": F.lit(f"{run_ts:%Y}")} if with_year else {}
    return {**parts, "mes": F.lit(f"{run_ts:%m}"), "dia": F.lit(f"{run_ts:%d}")}


def date_parts(ts: Column) -> dict[str, Column]:
    """The same partition values taken from a timestamp column."""
    return {
        "ano": F.date_format(ts, "yyyy"),
        "mes": F.date_format(ts, "MM"),
        "dia": F.date_format(ts, "dd"),
    }


def with_bronze_lineage(
    df: DataFrame, entity: str, run_ts: datetime, job: str = BATCH_JOB, source_type: str | None = None
) -> DataFrame:
    """The lineage columns of one load. ``run_ts`` is given once per run, so a run over midnight agrees."""
    lineage = {
        "_ingestion_timestamp": F.lit(run_ts).cast("timestamp"),
        "_ingestion_date": F.lit(f"{run_ts:%Y-%m-%d}"),
        "_source_entity": F.lit(entity),
        "_job_name": F.lit(job),
        "_record_hash": fingerprint(df.columns),
    }
    if source_type is not None:
        lineage["_source_type"] = F.lit(source_type)
    return df.withColumns(lineage)


def bronze_rows(df: DataFrame, entity: str, run_ts: datetime) -> DataFrame:
    """A raw batch entity with lineage and partition columns."""
    return with_bronze_lineage(df, entity, run_ts).withColumns(
        load_parts(run_ts, with_year=entity in DIRECTORY_ENTITIES)
    )


def bronze_events(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Raw events with lineage and partition columns; works on a stream as on a table."""
    stamped = with_bronze_lineage(df, EVENT_ENTITY, run_ts, STREAM_JOB, STREAM_SOURCE)
    return stamped.withColumns(load_parts(run_ts, with_year=False))


def stamp(df: DataFrame, layer: str, run_ts: datetime) -> DataFrame:
    return df.withColumn(f"_{layer}_processed_at", F.lit(run_ts).cast("timestamp"))


def drop_technical(df: DataFrame) -> DataFrame:
    return df.drop(*TECHNICAL_COLUMNS)
