"""Session settings and the shared work folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Split a hot key even where the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # At run time, joins whose smaller side has only small partitions hash that side instead of sorting both.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Skew as above for streams without state, such as enrichment by joins.
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
    # Partition values such as mes=07 stay text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Streaming state lives on disk, so its size is not bound by the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

SHUFFLE_BYTES = 256 << 20
UNKNOWN_SIZE = 1 << 60
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Steps that run at the same time, at most.
SIDE_BY_SIDE = 4
_SIZING = threading.Lock()
#: Per session, the setting as it was and the numbers that open ``sized_shuffles`` blocks ask for.
_sized: dict[str, tuple[str | None, list[int]]] = {}


def build_session(app_name: str = "lodestrata", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the recommended settings; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the recommended settings on a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def input_bytes(*tables: DataFrame) -> int:
    """Size of the files that some plans read, as the optimizer knows it from their leaves; nothing is read.

    Sources that state no size count nothing.
    """
    total = 0
    for df in tables:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        total += sum(size for size in sizes if size < UNKNOWN_SIZE)
    return total


@contextmanager
def sized_shuffles(spark: SparkSession, size: int) -> Iterator[None]:
    """Inside, shuffles start with partitions small enough to sort for an input of this many (compressed) bytes.

    Only ever raises the number, without a limit; adaptive execution joins what turns out too small. The setting is put back at the end.
    Of blocks open at the same time, on several threads, the largest number holds.
    """
    session = spark._jsparkSession.sessionUUID()
    with _SIZING:
        before, wanted = _sized.setdefault(session, (spark.conf.get(INITIAL_PARTITIONS, None), []))
        mine = max(int(before or spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHUFFLE_BYTES))
        wanted.append(mine)
        spark.conf.set(INITIAL_PARTITIONS, str(max(wanted)))
    try:
        yield
    finally:
        with _SIZING:
            wanted.remove(mine)
            if wanted:
                spark.conf.set(INITIAL_PARTITIONS, str(max(wanted)))
            else:
                del _sized[session]
                if before is None:
                    spark.conf.unset(INITIAL_PARTITIONS)
                else:
                    spark.conf.set(INITIAL_PARTITIONS, before)


def side_by_side(spark: SparkSession, steps: Sequence[Callable[[], object]]) -> list:
    """The results of steps that do not need each other, in order. They run at the same time: the last tasks of one leave no core idle.

    All run to their end, also beside one that fails; then the first failure in order is raised.
    """
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in begun]


def work_root(spark: SparkSession) -> str:
    """The folder all executors share, which the cluster names in ``spark.checkpoint.dir``. It must be set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one."""
    return f"{work_root(spark)}/lodestrata/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted; none where it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(target) if f.isDirectory())


@contextmanager
def work_table(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back for the length of a block; the folder is deleted after it."""
    spark = df.sparkSession
    path = work_folder(spark, label)
    try:
        df.write.mode("errorifexists").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For results used more than once: later readers do not recompute the plan, and a lost
    executor costs a re-read instead of the whole lineage.
    """
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
