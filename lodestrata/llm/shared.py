"""Intermediate tables in the folder all executors share, text expressions, and ranks without a hot task."""

from __future__ import annotations

import contextlib
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, as in a local try-out, a new one is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = Path(tempfile.mkdtemp(prefix="lodestrata-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/lodestrata-llm-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, label: str, *by: str) -> DataFrame:
    """``df`` written once to the shared folder, in folders ``by`` columns, and read back, so a lost executor costs a re-read and later readers no plan."""
    path = f"{shared_root(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote, once nothing that is still to run reads them."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete what ``stored`` wrote in this application; call it when no returned frame is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_parts(id_col: str) -> tuple[Column, Column]:
    """An id for Python without nulls, which pandas would turn into floats, and whether there is one: columns id and there."""
    ident = F.col(id_col).cast("long")
    return F.coalesce(ident, F.lit(0)).alias("id"), ident.isNotNull().alias("there")


def whole(text: str | Column) -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def remainder(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``: the folds that the queries hold out by. Null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % of


def spread_key(key: str) -> Column:
    """A number from the first 32 bits of the md5 of a column as text, which SQL elsewhere gives too."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def one_row(df: DataFrame) -> dict:
    """A single row of totals, as a dict."""
    return df.first().asDict()


def numbered(df: DataFrame, groups: Sequence[str], key: str, order: Sequence[str | Column], band: Column | None = None, name: str = "rank") -> DataFrame:
    """Adds the gapless rank (from 1) of each row within ``groups``, in the order (band, lane, ``order``).

    A window over a whole group would put a hot group into one task. Each group is cut into lanes by a hash of ``key``, about
    as many as a sixteenth of the root of the largest group's rows: rows are numbered in their lane, lanes are counted before
    the shuffle, and the running sum over a group's lanes is added. Both the lanes of a group and the rows of a lane grow with
    the root of the group only. Columns of ``df`` keep their names; helper columns start with ``__``.
    """
    keys = [f"__group{i}" for i in range(len(groups))]
    rows = df.withColumns({k: F.col(g) for k, g in zip(keys, groups, strict=True)}).withColumn("__band", F.lit(0) if band is None else band)
    largest = one_row(rows.groupBy(*keys).count().agg(F.max("count").alias("n")))["n"] or 0
    lanes = max(1, -(-int(largest**0.5) // 16))
    rows = rows.withColumn("__lane", spread_key(key) % lanes)
    lane = [*keys, "__band", "__lane"]
    before = Window.partitionBy(*keys).orderBy("__band", "__lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*lane).count().withColumn("__start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    starts = starts.select(*(F.col(c).alias(f"{c}s") for c in lane), "__start")
    placed = rows.withColumn("__row", F.row_number().over(Window.partitionBy(*lane).orderBy(*order)))
    same = [F.col(c).eqNullSafe(F.col(f"{c}s")) for c in lane]
    joined = placed.join(starts, same, "left").withColumn(name, F.col("__start") + F.col("__row"))
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), name)


def give_back() -> None:
    """For the end of a task in Python: memory that it has freed goes back to the system.

    A worker lives on for later tasks, beside the workers of other tasks, and would keep what its largest task took.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, and bound the rows they get at a time.

    Texts may be long, so a batch of Arrow's usual ten thousand rows may not fit a worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        target = shutil.make_archive(f"{tempfile.mkdtemp(prefix='lodestrata-')}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(target)
        _shipped.add(app)
