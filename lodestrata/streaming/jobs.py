"""Event jobs: raw store, duplicate suppression, quality gate, enrichment, latest state.

Each function starts a query that reads what is available and stops; run it again on the same
checkpoint to go on where it ended. Sinks written per micro-batch replace the folder of their own
batch id, so a batch that is repeated after a failure leaves the same files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lodestrata.contracts import EVENT_ENTITY, partition_columns
from lodestrata.functions.lineage import bronze_events
from lodestrata.operators.dedup import first_per_key
from lodestrata.operators.entities import event_time
from lodestrata.operators.integrate import EVENT_NETWORK, enrich_events
from lodestrata.operators.quality import REASON, Rule, quality_gate, with_row_reasons
from lodestrata.session import delete_folder, subfolders
from lodestrata.sources.manifest import Manifest, exists, manifest_or_empty, publish, read_manifest
from lodestrata.sources.tables import optional_scan, scan, scan_parts

ROUTE = "destino"
VALID, SET_ASIDE = "validos", "quarentena"
SLOT = "faixa"
#: Slots of the settled state at first, and the bytes a slot holds on average before their number doubles.
SLOTS, SLOT_BYTES = 16, 256 << 20
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def _append_files(df: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = ()) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.trigger(availableNow=True).start(path)


def _per_batch(df: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def store_bronze(events: DataFrame, path: str, checkpoint: str, run_ts: datetime) -> StreamingQuery:
    """Raw events with lineage, appended under year, month and day."""
    return _append_files(
        bronze_events(events, run_ts), path, checkpoint, partition_columns(EVENT_ENTITY, "bronze")
    )


def store_parsed(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return _append_files(events, path, checkpoint)


def store_unique(events: DataFrame, path: str, checkpoint: str, slots: int | None = None) -> StreamingQuery:
    """Stores each event id once, at its first arrival. Late events and events without a time are kept like any other.

    The ids that came before are the state of the query, hashed into ``slots`` parts (the session's shuffle partitions by default; fixed by the
    first run on a checkpoint). A micro-batch looks up its own ids there and reads nothing of what is stored, so it costs what it holds. The
    state lies on disk (RocksDB) and in the checkpoint, as changes since the last snapshot; it never expires, so an id is known however late it
    comes again. Of rows that share an id within a micro-batch one stays. A null id counts as an id.
    """
    spark = events.sparkSession
    settings = {CHANGELOG: "true"} | ({} if slots is None else {"spark.sql.shuffle.partitions": str(slots)})
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        # A query keeps the settings of its start.
        for key, value in settings.items():
            spark.conf.set(key, value)
        return _append_files(events.dropDuplicates(["event_id"]), path, checkpoint)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def store_enriched(
    events: DataFrame,
    municipio: DataFrame,
    meta_uf: DataFrame,
    path: str,
    checkpoint: str,
    network: str = EVENT_NETWORK,
) -> StreamingQuery:
    """Events joined to the stored directories (stream-static joins)."""
    return _append_files(enrich_events(events, municipio, meta_uf, network), path, checkpoint)


def store_checked(
    events: DataFrame, rules: Sequence[Rule], path: str, checkpoint: str, fail: bool = False
) -> StreamingQuery:
    """Judges each micro-batch and stores it in one write, valid rows and others under different folders.

    With ``fail`` a batch that breaks a critical rule stops the query before anything is written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if fail:
            quality_gate(batch, rules)
        judged = with_row_reasons(batch, rules)
        route = F.when(F.col(REASON).isNull(), F.lit(VALID)).otherwise(F.lit(SET_ASIDE))
        judged.withColumn(ROUTE, route).write.mode("overwrite").partitionBy(ROUTE).parquet(
            f"{path}/batch_id={batch_id}"
        )

    return _per_batch(events, checkpoint, write)


def store_latest(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Stores the latest state of each event id per micro-batch, as a log of changes.

    A micro-batch costs what it holds, not what the table holds; ``settle_events`` settles the
    batches against each other, once each, when the integration job folds them into the clean layer.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        first_per_key(batch, ["event_id"], [event_time().desc_nulls_last()]).write.mode("overwrite").parquet(
            f"{path}/batch_id={batch_id}"
        )

    return _per_batch(events, checkpoint, write)


def latest_events(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The latest state of each event id over all batches stored so far."""
    log = optional_scan(spark, path, schema)
    return first_per_key(log.select(*schema.fieldNames()), ["event_id"], [event_time().desc_nulls_last()])


def settled_events(spark: SparkSession, settled: str, schema: StructType) -> DataFrame:
    """The settled state as published last; NothingPublished where there is none."""
    return _settled(spark, settled, read_manifest(spark, settled), schema)


def _settled(spark: SparkSession, settled: str, manifest: Manifest, schema: StructType) -> DataFrame:
    return scan_parts(spark, settled, [part for _, part in sorted(manifest.parts.items()) if part is not None], schema)


def _finished(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder}/_SUCCESS")


def settle_events(spark: SparkSession, log: str, settled: str, schema: StructType, slots: int = SLOTS, slot_bytes: int = SLOT_BYTES) -> DataFrame:
    """The latest state of each event id, after folding the finished batches of the log into the settled state.

    The state is parted into slots by a hash of the id. Only the slots that new batches touch are read and written again, as new folders that a manifest names
    once all are finished; a run that dies before leaves the state and the log as they were. Batches are deleted after the manifest that
    holds them, and a batch that is not finished waits for the next run. When slots outgrow ``slot_bytes`` their number doubles, in a run that writes all of them.
    """
    manifest = manifest_or_empty(spark, settled)
    upto, count = manifest.state.get("upto", -1), manifest.state.get("slots", slots)
    batches = sorted(int(name.removeprefix("batch_id=")) for name in subfolders(spark, log) if name.startswith("batch_id="))
    new = [b for b in batches if b > upto and _finished(spark, f"{log}/batch_id={b}")]
    # Batches settle in their order: none after one that is still being written.
    waiting = min((b for b in batches if b > upto and b not in new), default=None)
    new = [b for b in new if waiting is None or b < waiting]
    if new:
        by_time = [event_time().desc_nulls_last()]
        wave = scan(spark, [f"{log}/batch_id={b}" for b in new], schema)
        # Only the ids are read for this; the batches meet each other and the state in one pass below.
        touched = sorted(r[0] for r in _slotted(wave.select("event_id"), count).select(SLOT).distinct().collect())
        held = [part for part in manifest.parts.values() if part is not None]
        size, grown = _bytes_below(spark, settled, held), count
        while size > grown * slot_bytes:
            grown *= 2
        names = [str(s) for s in touched] if grown == count else list(manifest.parts)
        old = scan_parts(spark, settled, [p for n in names if (p := manifest.parts.get(n)) is not None], schema)
        both = _slotted(old, grown).unionByName(_slotted(wave, grown))
        lot = f"versao={uuid.uuid4().hex}"
        latest = first_per_key(both, [SLOT, "event_id"], by_time)
        latest.hint("rebalance", SLOT).write.partitionBy(SLOT).parquet(f"{settled}/{lot}")
        written = {name.removeprefix(f"{SLOT}="): f"{lot}/{name}" for name in subfolders(spark, f"{settled}/{lot}") if name.startswith(f"{SLOT}=")}
        changes = {**dict.fromkeys(names if grown > count else ()), **written}
        manifest = publish(spark, settled, changes, {"upto": new[-1], "slots": grown}, manifest)
    for batch in (b for b in batches if b <= manifest.state.get("upto", -1)):
        delete_folder(spark, f"{log}/batch_id={batch}")
    return _settled(spark, settled, manifest, schema)


def _slotted(df: DataFrame, slots: int) -> DataFrame:
    return df.withColumn(SLOT, F.pmod(F.xxhash64("event_id"), F.lit(slots)).cast("int"))


def _bytes_below(spark: SparkSession, table: str, parts: Sequence[str]) -> int:
    files = spark._jvm.org.apache.hadoop.fs.Path(table).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(files.getContentSummary(spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{part}")).getLength() for part in parts)
