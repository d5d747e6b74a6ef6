"""Tables of the catalog over stored layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lodestrata.contracts import (
    BATCH_ENTITIES,
    EVENT_ENTITY,
    GOLD_VIEWS,
    INTEGRATED_ENTITY,
    LOAD,
    TARGET_YEARS,
    partition_columns,
    stored_schema,
)
from lodestrata.session import subfolders
from lodestrata.sources.layout import Lake
from lodestrata.sources.manifest import folder_of, manifest_or_empty
from lodestrata.sources.tables import path_missing, scan

#: Table properties that name the folder of each load in the catalog.
REGISTERED = "lodestrata.carga."


def register_table(
    spark: SparkSession, name: str, path: str, schema: StructType, partitions: Sequence[str] = ()
) -> DataFrame:
    """Declares an external table over the finished loads of a Parquet table; what no manifest names is not in it.

    Loads already in the catalog under the folder their manifest names are left alone, so a run pays for its own load only.
    """
    last = [schema[p] for p in partitions]
    columns = [f for f in schema.fields if f.name not in partitions] + last
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    layout = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING PARQUET {layout} LOCATION '{path}'")
    if partitions:
        known = _registered(spark, name)
        for load, part in manifest_or_empty(spark, path).parts.items():
            if known.get(load) != part:
                add_load(spark, name, path, load, part, partitions)
        told = ", ".join(f"'{REGISTERED}{load}' = '{part or ''}'" for load, part in manifest_or_empty(spark, path).parts.items())
        if told:
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({told})")
    return spark.table(name)


def _registered(spark: SparkSession, name: str) -> dict[str, str | None]:
    """The loads a table of the catalog has, with their folders."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"].removeprefix(REGISTERED): r["value"] or None for r in rows if r["key"].startswith(REGISTERED)}


def add_load(spark: SparkSession, name: str, path: str, load: str, part: str | None, partitions: Sequence[str]) -> None:
    """Puts the partitions of one load into the catalog, by the folders below the load's own, in place of those it had before."""
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{LOAD}` = '{load}')")
    found = [({LOAD: load}, folder_of(path, part))] if part is not None else []
    for column in (p for p in partitions if p != LOAD):
        found = [
            ({**spec, column: sub.partition("=")[2]}, f"{folder}/{sub}")
            for spec, folder in found for sub in subfolders(spark, folder) if sub.startswith(f"{column}=")
        ]
    if found:
        specs = (", ".join(f"`{k}` = '{v}'" for k, v in spec.items()) for spec, _ in found)
        added = " ".join(f"PARTITION ({spec}) LOCATION '{folder}'" for spec, (_, folder) in zip(specs, found, strict=True))
        spark.sql(f"ALTER TABLE {name} ADD {added}")


def register_stream_output(spark: SparkSession, name: str, path: str, schema: StructType) -> DataFrame:
    """A view over what a stream wrote. Its own log of finished files says what belongs to it, so rows of
    a batch that is being written are not seen; a table over the folder would not know that log."""
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{path}`")
    return spark.table(name)


def lake_tables(lake: Lake) -> dict[str, tuple[str, str, str]]:
    """Every table of a lake: its name with the entity, layer and path behind it."""
    tables = {entity: (entity, "bronze", lake.bronze(entity)) for entity in BATCH_ENTITIES}
    tables[EVENT_ENTITY] = (EVENT_ENTITY, "bronze", lake.bronze_stream(EVENT_ENTITY))
    for entity in (*BATCH_ENTITIES, INTEGRATED_ENTITY):
        tables[f"silver_{entity}"] = (entity, "silver", lake.silver(entity))
    for view in GOLD_VIEWS:
        tables[f"gold_{view}"] = (view, "gold", lake.gold(view))
    return tables


def register_lake(
    spark: SparkSession, lake: Lake, database: str, target_years: Sequence[int] = tuple(TARGET_YEARS)
) -> list[str]:
    """Registers the tables of a lake that are stored; returns their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, (entity, layer, path) in lake_tables(lake).items():
        schema = stored_schema(entity, layer, target_years)
        if entity != EVENT_ENTITY:
            if manifest_or_empty(spark, path).parts:
                names.append(f"{database}.{name}")
                register_table(spark, names[-1], path, schema, partition_columns(entity, layer))
            continue
        try:
            scan(spark, path, schema)
        except AnalysisException as error:
            if not path_missing(error):
                raise
            continue
        names.append(f"{database}.{name}")
        register_stream_output(spark, names[-1], path, schema)
    return names
