from datetime import datetime, timedelta, timezone

import pytest
from conftest import plan, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lodestrata.contracts import EVENT_ENTITY, INTEGRATED_ENTITY, schema_for, stored_schema
from lodestrata.functions.events import decode_events, encode_events
from lodestrata.functions.lineage import bronze_rows
from lodestrata.operators.quality import QualityError, rule_book
from lodestrata.plans.jobs import Run, bronze_job, gold_job, gold_jobs, integration_job, silver_job, silver_jobs
from lodestrata.plans.validation import validate_lake
from lodestrata.session import INITIAL_PARTITIONS, SHUFFLE_BYTES, input_bytes, materialise, sized_shuffles, subfolders, work_folder, work_table
from lodestrata.sources.catalog import register_lake, register_table
from lodestrata.sources.layout import Lake
from lodestrata.sources.sinks import publish_load, stage_layer, write_layer, write_partitions
from lodestrata.sources.manifest import NothingPublished, PublicationConflict, publish, read_manifest
from lodestrata.sources.tables import extract, optional_scan, loads, scan, scan_load, scan_loads, stored_or
from lodestrata.streaming import jobs
from lodestrata.streaming.source import WIRE_COLUMNS, NoEventsError, drain, file_wire, kafka_options, wire_of

DAY1 = datetime(2026, 7, 11, 8, tzinfo=timezone.utc)
DAY2 = DAY1 + timedelta(days=1)


@pytest.fixture
def folder(spark):
    return lambda label: work_folder(spark, label)


def test_work_folder_is_below_the_shared_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "a").startswith(root) and work_folder(spark, "a") != work_folder(spark, "a")


def test_materialise_keeps_rows_and_cuts_the_plan(spark):
    df = spark.range(10).groupBy((F.col("id") % 3).alias("k")).count()
    stored = materialise(df, "t")
    assert rows(stored) == rows(df) and "Aggregate" not in plan(stored)


def test_shuffles_grow_with_the_input_and_only_for_a_block(spark):
    with sized_shuffles(spark, 1 << 20):
        assert spark.conf.get(INITIAL_PARTITIONS) == spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffles(spark, 100 << 40):
        assert spark.conf.get(INITIAL_PARTITIONS) == str((100 << 40) // SHUFFLE_BYTES)
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_work_table_is_deleted_after_its_block(spark):
    df = spark.range(10)
    with work_table(df, "t") as stored:
        path = stored.inputFiles()[0].rsplit("/", 1)[0]
        assert rows(stored) == rows(df)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_size_of_an_input_is_that_of_its_files(spark, folder):
    path = folder("small")
    spark.range(10).coalesce(1).write.parquet(path)
    assert 0 < input_bytes(spark.read.parquet(path)) < 10_000


def test_a_load_replaces_its_own_day_only(spark, folder):
    path, schema = folder("bronze"), stored_schema("uf", "bronze")
    df = spark.createDataFrame([("1", "SP", "n", "r")], schema_for("uf", "bronze", lineage=False))
    for day in (DAY1, DAY2, DAY2):
        write_layer(bronze_rows(df, "uf", day), path, "uf", "bronze", day)
    stored = scan_loads(spark, path, schema)
    assert rows(stored, "sigla", "ano", "mes", "dia") == [("SP", "2026", "07", "11"), ("SP", "2026", "07", "12")]
    write_layer(bronze_rows(df.where("false"), "uf", DAY1), path, "uf", "bronze", DAY1)
    assert rows(scan_loads(spark, path, schema), "carga") == [("2026-07-12",)]
    write_layer(bronze_rows(df.where("false"), "uf", DAY2), path, "uf", "bronze", DAY2)
    assert scan_load(spark, path, schema).isEmpty() and loads(spark, path) == ["2026-07-11", "2026-07-12"]


def test_the_newest_load_is_read_by_its_partition(spark, folder):
    path, schema = folder("bronze"), stored_schema("uf", "bronze")
    df = spark.createDataFrame([("1", "SP", "n", "r")], schema_for("uf", "bronze", lineage=False))
    for day in (DAY1, DAY2):
        write_layer(bronze_rows(df, "uf", day), path, "uf", "bronze", day)
    newest = scan_load(spark, path, schema)
    assert rows(newest, "carga") == [("2026-07-12",)]
    assert all("carga=2026-07-12" in file for file in newest.inputFiles())


def uf_rows(spark, *codes):
    return spark.createDataFrame([("1", c, "n", "r") for c in codes], schema_for("uf", "bronze", lineage=False))


def test_an_unfinished_load_is_not_read(spark, folder):
    path, schema = folder("bronze"), stored_schema("uf", "bronze")
    with pytest.raises(NothingPublished):
        scan_load(spark, path, schema)
    write_layer(bronze_rows(uf_rows(spark, "SP"), "uf", DAY1), path, "uf", "bronze", DAY1)
    fail = F.udf(lambda x: 1 // 0, "string")
    for day in (DAY1, DAY2):  # of the same day, and of the next
        broken = bronze_rows(uf_rows(spark, "RJ").withColumn("sigla", fail("sigla")), "uf", day)
        with pytest.raises(Exception, match="ZeroDivisionError"):
            write_layer(broken, path, "uf", "bronze", day)
        spark.range(1).write.parquet(f"{path}/carga={day:%Y-%m-%d}/lote=died")
        assert rows(scan_load(spark, path, schema), "sigla", "carga") == [("SP", "2026-07-11")]
        assert rows(scan_loads(spark, path, schema), "sigla") == [("SP",)] and loads(spark, path) == ["2026-07-11"]
    # Written whole but not published: still the load of the day before.
    staged = stage_layer(bronze_rows(uf_rows(spark, "RJ"), "uf", DAY2), path, "uf", "bronze", DAY2)
    assert rows(scan_load(spark, path, schema), "sigla") == [("SP",)]
    publish_load(spark, path, DAY2, staged)
    assert rows(scan_load(spark, path, schema), "sigla", "carga") == [("RJ", "2026-07-12")]


def test_readers_of_a_replaced_load_may_finish(spark, folder):
    path, schema = folder("bronze"), stored_schema("uf", "bronze")
    write_layer(bronze_rows(uf_rows(spark, "SP"), "uf", DAY1), path, "uf", "bronze", DAY1)
    before = scan_load(spark, path, schema).select("sigla")
    old = read_manifest(spark, path).parts["2026-07-11"]
    write_layer(bronze_rows(uf_rows(spark, "RJ"), "uf", DAY1), path, "uf", "bronze", DAY1)
    assert rows(before) == [("SP",)] and rows(scan_load(spark, path, schema), "sigla") == [("RJ",)]
    assert read_manifest(spark, path).replaced == (old,)
    write_layer(bronze_rows(uf_rows(spark, "AC"), "uf", DAY1), path, "uf", "bronze", DAY1)
    assert old.rpartition("/")[2] not in subfolders(spark, f"{path}/carga=2026-07-11")


def test_a_second_writer_is_refused(spark, folder):
    path = folder("t")
    first = publish(spark, path, {"a": None})
    publish(spark, path, {"b": None})
    with pytest.raises(PublicationConflict):
        publish(spark, path, {"c": None}, before=first)
    assert sorted(read_manifest(spark, path).parts) == ["a", "b"]
    for _ in range(12):
        publish(spark, path, {"a": None})
    assert read_manifest(spark, path).number == 14


def test_many_batches_are_one_reader(spark, folder):
    path, schema = folder("log"), schema_for("uf", "silver").add("batch_id", "integer")
    for i in range(30):
        spark.createDataFrame([(str(i),)], "id_uf string").coalesce(1).write.parquet(f"{path}/batch_id={i}")
    both = scan(spark, [f"{path}/batch_id={i}" for i in range(5, 30)], schema)
    assert set(rows(both, "batch_id", "id_uf")) == {(i, str(i)) for i in range(5, 30)} and both.count() == 25
    assert plan(both).count("FileScan") == 1


def test_rebalanced_write(spark, folder):
    path = folder("t")
    df = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("p"))
    write_partitions(df, path, ["p"], rebalance=True)
    assert rows(spark.read.parquet(path).groupBy("p").count().select("count")) == [(33,), (33,), (34,)]


def test_missing_paths(spark, folder):
    schema = schema_for("uf", "silver")
    empty = optional_scan(spark, folder("nothing"), schema)
    assert empty.isEmpty() and empty.columns == schema.fieldNames()
    assert stored_or(lambda: scan(spark, folder("nothing"), schema), lambda: spark.range(1)).count() == 1

    def broken():
        return spark.range(1).select("no_such_column")

    with pytest.raises(AnalysisException):
        stored_or(broken, lambda: spark.range(1))


def test_extract_reaches_the_scan(spark, folder):
    path = folder("source")
    spark.range(10).select(
        (F.lit(2020) + F.col("id")).cast("int").alias("ano"), F.col("id").alias("id_municipio"), F.lit("x").alias("other")
    ).write.parquet(path)
    got = extract(spark.read.parquet(path), ["ano", "id_municipio"], years=[2023, 2024])
    assert rows(got) == [(2023, "3"), (2024, "4")]
    text = plan(got)
    assert "In(ano, [2023,2024])" in text and "other" not in text


def test_partitions_prune_the_scan(spark, folder):
    path = folder("facts")
    df = spark.createDataFrame([(2023, "a"), (2024, "b")], "ano int, rede string")
    write_layer(df, path, "meta_brasil", "bronze", DAY1)
    schema = schema_for("meta_brasil", "bronze", lineage=False).add("mes", "string").add("dia", "string")
    got = scan_loads(spark, path, schema).where("ano = 2024").select("rede")
    assert rows(got) == [("b",)] and "PartitionFilters: [isnotnull(ano" in plan(got)


def test_catalog_table_sees_partitions(spark, folder):
    path = folder("catalog")
    write_layer(spark.createDataFrame([(2024, "a")], "ano int, rede string"), path, "meta_brasil", "silver", DAY1)
    schema = spark.createDataFrame([], "ano int, rede string, carga string, mes string, dia string").schema
    table = register_table(spark, "t_catalog", path, schema, ("carga", "mes", "dia"))
    assert rows(table) == [(2024, "a", "2026-07-11", "07", "11")]
    spark.sql("DROP TABLE t_catalog")


# --- Streams --------------------------------------------------------------------------------------

FLAT = schema_for(EVENT_ENTITY, "bronze", lineage=False)


def event(id_, ts, rate=50.0, kind="medicao_nova", key="1"):
    return (id_, kind, ts, key, None, 2024, rate, 80.0)


def put(spark, bus, *events):
    encode_events(spark.createDataFrame(list(events), FLAT)).coalesce(1).write.mode("append").parquet(bus)


def arriving(spark, bus, **options):
    return decode_events(file_wire(spark, bus, **options))


def at(hour, day=12):
    return f"2026-07-{day:02d}T{hour:02d}:00:00+00:00"


def test_records_of_a_bus(spark):
    """Options of the reader, and records as a broker delivers them: bytes beside columns of its own."""
    assert kafka_options("a:9092,b:9092", "t", 500) == {"kafka.bootstrap.servers": "a:9092,b:9092", "subscribe": "t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "500"}
    assert "maxOffsetsPerTrigger" not in kafka_options("a:9092")
    sent = encode_events(spark.createDataFrame([event("é1", at(1), 61.5, key="0000001")], FLAT)).first()
    records = [(bytearray(sent.key.encode()), bytearray(sent.value.encode()), "t", 0, 7), (None, bytearray(b"no json"), "t", 0, 8), (None, None, "t", 1, 0)]
    wire = wire_of(spark.createDataFrame(records, "key binary, value binary, topic string, partition int, offset long"))
    assert wire.schema.simpleString() == spark.createDataFrame([], WIRE_COLUMNS).schema.simpleString()
    want = [(None, None, None), (None, None, None), ("é1", 61.5, "0000001")]
    assert rows(decode_events(wire), "event_id", "taxa_alfabetizacao", "id_municipio") == sorted(want, key=repr)


def test_a_repeated_run_adds_nothing(spark, folder):
    bus, out, checkpoint = folder("bus"), folder("out"), folder("cp")
    put(spark, bus, event("a", at(1)), event("b", at(2)))
    assert drain(jobs.store_bronze(arriving(spark, bus), out, checkpoint, DAY1)) == 2
    with pytest.raises(NoEventsError):
        drain(jobs.store_bronze(arriving(spark, bus), out, checkpoint, DAY1))
    put(spark, bus, event("c", at(3)))
    assert drain(jobs.store_bronze(arriving(spark, bus), out, checkpoint, DAY2), timeout_seconds=60) == 1
    stored = scan(spark, out, stored_schema(EVENT_ENTITY, "bronze"))
    assert rows(stored, "event_id", "ano", "mes", "dia", "_source_type") == [
        ("a", 2024, "07", "11", "streaming"),
        ("b", 2024, "07", "11", "streaming"),
        ("c", 2024, "07", "12", "streaming"),
    ]


@pytest.mark.parametrize("slots", [1, 4])
def test_duplicates_and_late_rows(spark, folder, slots):
    bus, out, checkpoint = folder("bus"), folder("out"), folder("cp")
    put(spark, bus, event("a", at(10)), event("a", at(11)))
    drain(jobs.store_unique(arriving(spark, bus), out, checkpoint, slots))
    put(spark, bus, event("a", at(11)), event("b", at(20)))  # a again
    drain(jobs.store_unique(arriving(spark, bus), out, checkpoint, slots))
    put(spark, bus, event("c", at(1)), event("d", "no time"), event("d", "no time"))  # c is hours late
    drain(jobs.store_unique(arriving(spark, bus), out, checkpoint, slots))
    put(spark, bus, event("d", "no time"), event("c", at(1)))
    drain(jobs.store_unique(arriving(spark, bus), out, checkpoint, slots))
    assert rows(scan(spark, out, FLAT), "event_id") == [("a",), ("b",), ("c",), ("d",)]


def test_latest_state_over_batches(spark, folder):
    bus, out, checkpoint = folder("bus"), folder("out"), folder("cp")
    assert jobs.latest_events(spark, out, FLAT).isEmpty()
    put(spark, bus, event("a", at(10), 1.0), event("b", at(10), 1.0))
    drain(jobs.store_latest(arriving(spark, bus), out, checkpoint))
    put(spark, bus, event("a", at(12), 2.0), event("b", at(9), 2.0))  # b arrives late and is older
    drain(jobs.store_latest(arriving(spark, bus), out, checkpoint))
    assert rows(jobs.latest_events(spark, out, FLAT), "event_id", "taxa_alfabetizacao") == [("a", 2.0), ("b", 1.0)]


def test_settled_events_read_each_batch_once(spark, folder):
    bus, out, settled, checkpoint = folder("bus"), folder("out"), folder("settled"), folder("cp")
    for wave in ([event("a", at(10), 1.0), event("b", at(10), 1.0)], [event("a", at(12), 2.0)], [event("b", at(9), 2.0)]):
        put(spark, bus, *wave)
        drain(jobs.store_latest(arriving(spark, bus), out, checkpoint))
        current = jobs.settle_events(spark, out, settled, FLAT)
    assert rows(current, "event_id", "taxa_alfabetizacao") == [("a", 2.0), ("b", 1.0)]
    assert subfolders(spark, out) == [] and read_manifest(spark, settled).state == {"upto": 2, "slots": jobs.SLOTS}
    assert sorted(jobs.settle_events(spark, out, settled, FLAT).inputFiles()) == sorted(current.inputFiles())


def log_batch(spark, log, batch_id, *events):
    spark.createDataFrame(list(events), FLAT).write.parquet(f"{log}/batch_id={batch_id}")


def test_a_run_that_dies_while_settling_loses_nothing(spark, folder, monkeypatch):
    log, settled = folder("log"), folder("settled")
    assert jobs.settle_events(spark, log, settled, FLAT).isEmpty()
    log_batch(spark, log, 0, event("a", at(1), 1.0), event("b", at(1), 1.0))
    jobs.settle_events(spark, log, settled, FLAT)
    log_batch(spark, log, 1, event("a", at(2), 2.0))

    def dies(*_, **__):
        raise RuntimeError("died")

    with monkeypatch.context() as m:  # all files are there, the manifest is not
        m.setattr(jobs, "publish", dies)
        with pytest.raises(RuntimeError, match="died"):
            jobs.settle_events(spark, log, settled, FLAT)
    assert rows(jobs.settled_events(spark, settled, FLAT), "event_id", "taxa_alfabetizacao") == [("a", 1.0), ("b", 1.0)]
    assert subfolders(spark, log) == ["batch_id=1"]
    # A folder that a dead writer left, and a batch without its end: neither is read, and no later batch overtakes it.
    spark.range(1).write.parquet(f"{settled}/versao=left")
    spark.range(1).write.parquet(f"{log}/batch_id=2/_temporary/0")
    log_batch(spark, log, 3, event("b", at(3), 3.0))
    assert rows(jobs.settle_events(spark, log, settled, FLAT), "event_id", "taxa_alfabetizacao") == [("a", 2.0), ("b", 1.0)]
    spark.createDataFrame([event("c", at(1), 4.0)], FLAT).write.mode("overwrite").parquet(f"{log}/batch_id=2")
    assert rows(jobs.settle_events(spark, log, settled, FLAT), "event_id", "taxa_alfabetizacao") == [("a", 2.0), ("b", 3.0), ("c", 4.0)]
    assert subfolders(spark, log) == []


def test_settling_writes_what_the_wave_touches(spark, folder):
    log, settled = folder("log"), folder("settled")
    log_batch(spark, log, 0, *(event(f"e{i}", at(1), 1.0) for i in range(600)))
    jobs.settle_events(spark, log, settled, FLAT, slots=64)
    first = read_manifest(spark, settled)
    log_batch(spark, log, 1, event("e5", at(2), 2.0), event("e6", at(2), 2.0))
    current = jobs.settle_events(spark, log, settled, FLAT, slots=64)
    second = read_manifest(spark, settled)
    changed = [n for n in second.parts if second.parts[n] != first.parts.get(n)]
    assert len(first.parts) == 64 and 1 <= len(changed) <= 2
    assert rows(current.groupBy("taxa_alfabetizacao").count()) == [(1.0, 598), (2.0, 2)]
    assert plan(current).count("FileScan") == 1
    # Full slots are cut in two, all of them in one run.
    log_batch(spark, log, 2, event("e7", at(2), 3.0))
    size = jobs._bytes_below(spark, settled, list(second.parts.values()))
    current = jobs.settle_events(spark, log, settled, FLAT, slot_bytes=size // 100)
    assert read_manifest(spark, settled).state == {"upto": 2, "slots": 128}
    assert current.count() == 600 and current.select("event_id").distinct().count() == 600
    log_batch(spark, log, 3, event("e8", at(2), 4.0))
    current = jobs.settle_events(spark, log, settled, FLAT)
    assert current.count() == 600 and rows(current.where("taxa_alfabetizacao > 2"), "event_id") == [("e7",), ("e8",)]


def test_suppression_reads_nothing_of_what_is_stored(spark, folder):
    bus, out, checkpoint = folder("bus"), folder("out"), folder("cp")
    for wave in range(2):
        put(spark, bus, event("a", at(10)), event(f"b{wave}", at(11)))
        query = jobs.store_unique(arriving(spark, bus), out, checkpoint, 4)
        drain(query)
    text = query._jsq.explainInternal(False)
    assert "StreamingDeduplicate" in text and out not in text and text.count("Scan") == 1
    assert rows(scan(spark, out, FLAT), "event_id") == [("a",), ("b0",), ("b1",)]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4" and spark.conf.get(jobs.CHANGELOG, None) is None


def test_a_batch_written_twice_is_stored_once(spark, folder):
    """What a restart after a failure does: the same batch id again."""
    out, written = folder("out"), []

    class Stream:
        def __getattr__(self, name):
            return lambda *a, **k: self

        def foreachBatch(self, write):
            written.append(write)
            return self

    class Events:
        writeStream = Stream()

    jobs.store_latest(Events(), out, "cp")
    batch = spark.createDataFrame([event("a", at(1))], FLAT)
    written[0](batch, 0)
    written[0](batch, 0)
    assert spark.read.parquet(out).count() == 1


def test_stream_gate(spark, folder):
    bus, out = folder("bus"), folder("out")
    put(spark, bus, event("a", at(1), key="123"), event("b", at(1), key="0000001"))
    rules = rule_book()[EVENT_ENTITY, "bronze"]
    drain(jobs.store_checked(arriving(spark, bus), rules, out, folder("cp")))
    assert rows(spark.read.parquet(out), "event_id", "_motivo_quarentena", "destino") == [
        ("a", "id_municipio", "quarentena"),
        ("b", None, "validos"),
    ]
    query = jobs.store_checked(arriving(spark, bus), rules, folder("none"), folder("cp"), fail=True)
    with pytest.raises(Exception, match="critical rules failed"):
        query.awaitTermination()


def test_stream_and_batch_agree(spark, folder):
    from lodestrata.operators.integrate import enrich_events

    municipio = spark.createDataFrame(
        [("1", "SP", "n", "u")], "id_municipio string, sigla_uf string, nome_municipio string, nome_uf string"
    )
    meta_uf = spark.createDataFrame([("SP", 2024, "P", 9.0)], "sigla_uf string, ano int, rede string, taxa_alfabetizacao double")
    bus, out = folder("bus"), folder("out")
    put(spark, bus, event("a", at(1)), event("b", at(2), key="unknown"))
    drain(jobs.store_enriched(arriving(spark, bus), municipio, meta_uf, out, folder("cp")))
    batch = enrich_events(decode_events(spark.read.parquet(bus)), municipio, meta_uf)
    stored = spark.read.parquet(out)
    assert rows(stored, *sorted(batch.columns)) == rows(batch, *sorted(batch.columns))


# --- Jobs -----------------------------------------------------------------------------------------


@pytest.fixture
def run(spark, folder):
    book = {at: rules for at, rules in rule_book().items() if at[0] != "uf" or at[1] != "bronze"}
    book["municipio", "bronze"] = book["municipio", "bronze"][:3]  # no least number of rows
    return Run(spark, Lake(folder("lake")), DAY1, rules=book)


def raw(spark, entity, data):
    schema = schema_for(entity, "bronze", lineage=False)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in data], schema)


def load(run, spark):
    targets = {f"meta_alfabetizacao_{y}": 60.0 for y in range(2024, 2031)}
    bronze_job(run, raw(spark, "uf", [{"id_uf": "35", "sigla": "sp", "nome": "são paulo", "regiao": "Sudeste"}]), "uf")
    towns = [{"id_municipio": f"000000{i}", "sigla_uf": "sp", "nome": f"cidade {i}"} for i in (1, 2)]
    bronze_job(run, raw(spark, "municipio", towns), "municipio")
    bronze_job(run, raw(spark, "meta_uf", [{"ano": 2024, "sigla_uf": "SP", "rede": "P", "taxa_alfabetizacao": 70.0, **targets}]), "meta_uf")
    bronze_job(run, raw(spark, "meta_brasil", [{"ano": 2024, "rede": "P", "taxa_alfabetizacao": 50.0, **targets}]), "meta_brasil")
    facts = [
        {"ano": 2024, "id_municipio": "0000001", "rede": "P", "taxa_alfabetizacao": 61.5, **targets},
        {"ano": 2024, "id_municipio": "0000002", "rede": "P", "taxa_alfabetizacao": None, **targets},
        {"ano": 2024, "id_municipio": "0000009", "rede": "P", "taxa_alfabetizacao": 40.0, **targets},
    ]
    bronze_job(run, raw(spark, "meta_municipio", facts), "meta_municipio")
    students = [{"ano": 2024, "id_municipio": "0000001", "id_aluno": str(i), "proficiencia": 700.0 + 50 * i} for i in (0, 0, 1)]
    bronze_job(run, raw(spark, "alunos", students), "alunos")


def test_all_jobs(run, spark, folder):
    load(run, spark)
    bus = folder("bus")
    put(spark, bus, event("e1", at(1), 64.0, key="0000001"), event("e1", at(2), 65.0, key="0000001"))
    drain(jobs.store_bronze(arriving(spark, bus), run.lake.bronze_stream(EVENT_ENTITY), run.lake.checkpoint("b"), DAY1))
    summary = {s["entidade"]: s for s in silver_jobs(run)}
    assert summary["alunos"]["silver_linhas"] == 2 and summary["meta_municipio"]["silver_linhas"] == 3
    result = integration_job(run)
    assert (result["silver_linhas"], result["quarentena_linhas"]) == (3, 1)
    aside = run.quarantine(INTEGRATED_ENTITY)
    assert rows(aside, "id_municipio", "_motivo_quarentena") == [("0000009", "municipio_inexistente")]
    assert [s["linhas"] for s in gold_jobs(run)] == [2, 1, 2]
    view = run.gold("indicador_municipio")
    assert rows(view, "nome", "nome_uf", "pct_alfabetizados", "gap_meta", "indicador_uf", "total_alunos_avaliados") == [
        ("Cidade 1", None, 61.5, 1.5, 70.0, 2),
        ("Cidade 2", None, None, None, 70.0, None),
    ]
    assert rows(run.silver(INTEGRATED_ENTITY).where("event_id = 'e1'"), "rede", "taxa_alfabetizacao") == [("total", 65.0)]
    with pytest.raises(KeyError):
        gold_job(run, "unknown")

    report = validate_lake(run, {"alunos": (3, 3), "gold_indicador_municipio": (5, 9)})
    assert rows(report, "nome", "aprovado") == [
        ("dq_bronze_streaming", True),
        ("dq_duplicidade_silver_municipio", True),
        ("dq_gap_meta_consistente", True),
        ("dq_orfaos_integrado", True),
        ("dq_streaming_presente", True),
        ("volume_alunos", True),
        ("volume_gold_indicador_municipio", False),
    ]
    names = register_lake(spark, run.lake, "lake_test")
    assert len(names) == 17
    assert spark.table("lake_test.gold_indicador_municipio").count() == 2
    assert rows(spark.table("lake_test.indicador_alfabetizacao"), "event_id", "dia") == [("e1", "11")] * 2
    spark.sql("DROP DATABASE lake_test CASCADE")


def test_a_second_day_replaces_what_readers_see(run, spark):
    load(run, spark)
    silver_jobs(run)
    later = Run(spark, run.lake, DAY2, rules=run.rules)
    load(later, spark)
    assert later.bronze("alunos").count() == 3  # the newest snapshot alone
    silver_jobs(later)
    assert later.silver("alunos").count() == 2
    stored = scan_loads(spark, run.lake.silver("alunos"), stored_schema("alunos", "silver"))
    assert stored.count() == 4  # the first day is still there


def test_integration_without_silver_or_events(run, spark):
    load(run, spark)
    assert integration_job(run)["silver_linhas"] == 2


def test_gate_mode_stops_and_quarantine_mode_sets_aside(run, spark):
    targets = {f"meta_alfabetizacao_{y}": 60.0 for y in range(2024, 2030)}
    good = {"ano": 2024, "rede": "P", "taxa_alfabetizacao": 50.0, **targets, "meta_alfabetizacao_2030": 80.0}
    bad = {**good, "rede": "E", "meta_alfabetizacao_2030": None}
    bronze_job(run, raw(spark, "meta_brasil", [good, bad]), "meta_brasil")
    strict = Run(spark, run.lake, DAY1, rules=run.rules, on_violation="gate")
    with pytest.raises(QualityError, match="meta_alfabetizacao_2030"):
        silver_job(strict, "meta_brasil")
    with pytest.raises(NothingPublished):
        run.silver("meta_brasil")
    assert silver_job(run, "meta_brasil") == {"entidade": "meta_brasil", "silver_linhas": 1, "quarentena_linhas": 1}


def test_bad_raw_data_is_not_stored(run, spark):
    with pytest.raises(QualityError):
        bronze_job(run, raw(spark, "meta_uf", [{"ano": None, "sigla_uf": "SP"}]), "meta_uf")
    with pytest.raises(NothingPublished):
        run.bronze("meta_uf")
