"""Reading tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestrata.contracts import LOAD
from lodestrata.sources.manifest import NothingPublished, folder_of, manifest_or_empty, read_manifest


def scan(spark: SparkSession, path: str | Sequence[str], schema: StructType) -> DataFrame:
    """A partitioned Parquet tree, or several as one table.

    Partition columns take the types the schema declares, so ``mes=07`` stays text. Folders of one tree (``x/batch_id=1``, ``x/batch_id=2``) are one
    reader however many they are; their own partition column is read if the schema has it. Trees of different roots are united.
    """
    paths = [path] if isinstance(path, str) else list(path)
    roots = {p.rpartition("/")[0] for p in paths}
    if len(paths) > 1 and len(roots) == 1 and all("=" in p.rpartition("/")[2] for p in paths):
        return _below(spark, roots.pop(), paths, schema)
    return reduce(DataFrame.unionByName, (spark.read.schema(schema).parquet(p) for p in paths))


def _below(spark: SparkSession, root: str, folders: Sequence[str], schema: StructType) -> DataFrame:
    """Folders below one root by one reader, with the columns of the schema: from the files, or from the names of folders."""
    return spark.read.schema(schema).option("basePath", root).parquet(*folders).select(*schema.fieldNames())


def scan_parts(spark: SparkSession, table: str, folders: Sequence[str], schema: StructType) -> DataFrame:
    """Parts that a manifest names, one reader for those below the table and one for each other table they lie in."""
    by_root: dict[str, list[str]] = {}
    for folder in folders:
        full = folder_of(table, folder)
        by_root.setdefault(table if full.startswith(f"{table}/") else full.partition(f"/{LOAD}=")[0], []).append(full)
    if not by_root:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, (_below(spark, root, own, schema) for root, own in by_root.items()))


def loads(spark: SparkSession, path: str) -> list[str]:
    """Dates of the finished loads of a table, oldest first, from its manifest alone."""
    return sorted(manifest_or_empty(spark, path).parts)


def scan_loads(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All finished loads of a table; NothingPublished where there is none."""
    parts = read_manifest(spark, path).parts
    return scan_parts(spark, path, [part for _, part in sorted(parts.items()) if part is not None], schema)


def scan_load(spark: SparkSession, path: str, schema: StructType, load: str | None = None) -> DataFrame:
    """One finished load of a table, the newest by default; no other folder is listed. A load without rows gives none."""
    parts = read_manifest(spark, path).parts
    chosen = parts.get(load or max(parts))
    return scan_parts(spark, path, [] if chosen is None else [chosen], schema)


def path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def optional_scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, or an empty one of the same schema where the path does not exist. Other errors stay."""
    return stored_or(lambda: scan(spark, path, schema), lambda: spark.createDataFrame([], schema))


def stored_or(stored: Callable[[], DataFrame], otherwise: Callable[[], DataFrame]) -> DataFrame:
    """The stored table where its path exists or a load of it is published, else the plan that would have produced it."""
    try:
        return stored()
    except NothingPublished:
        return otherwise()
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return otherwise()


def extract(
    source: DataFrame,
    columns: Sequence[str],
    years: Sequence[int] | None = None,
    text_keys: Sequence[str] = ("id_municipio",),
) -> DataFrame:
    """The wanted columns of the wanted years, keys as text.

    ``source`` comes from any reader (Parquet, JDBC, a warehouse connector); both the columns and the
    year test are pushed down to it.
    """
    chosen = source.where(F.col("ano").isin(*years)) if years is not None else source
    return chosen.select(*(F.col(c).cast("string").alias(c) if c in text_keys else F.col(c) for c in columns))
