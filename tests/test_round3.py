"""Queries and jobs on rows of the tests' own."""

from datetime import datetime, timezone

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lodestrata.contracts import EVENT_ENTITY, INTEGRATED_ENTITY, schema_for
from lodestrata.operators import integrate
from lodestrata.operators.quality import REASON
from lodestrata.plans import jobs as layer_jobs
from lodestrata.plans.jobs import Run, silver_jobs
from lodestrata.session import INITIAL_PARTITIONS, SHUFFLE_BYTES, side_by_side, sized_shuffles, work_folder
from lodestrata.sources.layout import Lake
from lodestrata.streaming import jobs as streaming
from workload.fixtures import BASE_TABLES
from workload.registry import QUERIES


def given_tables(spark, **tables):
    """A folder of the given tables with these rows."""
    path = work_folder(spark, "given")
    for name, found in tables.items():
        spark.createDataFrame(found, BASE_TABLES[name]).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def test_job_integration_sets_raw_faults_aside_and_returns_them(spark):
    day = datetime(1997, 3, 4)
    sf_dir = given_tables(
        spark,
        region=[(0, "NORTH")],
        nation=[(0, "NATION_0", 0)],
        customer=[(k, f"Customer {k}", 0, 1.0, "M") for k in range(1, 121)],
        orders=[(1, 1, "O", 100_000.0, day, "5-LOW"), (2, 2, "O", 600_000.0, day, "5-LOW"), (3, 13, "O", 100_000.0, day, "5-LOW")],
        events=[(8, datetime(2024, 1, 2), 1, "click", 5.0, "{}")],
    )
    found = QUERIES["job_integration"](spark, sf_dir)
    assert rows(found.where("entidade = 'municipio'").groupBy(REASON).count()) == [("id_municipio", 9)]
    facts = found.where("entidade <> 'municipio'").select("entidade", "id_municipio", "rede", F.col(REASON))
    assert rows(facts.where(F.col(REASON).isNull())) == [(INTEGRATED_ENTITY, "0000001", "O", None), (INTEGRATED_ENTITY, "0000001", "total", None)]
    assert rows(facts.where(F.col(REASON).isNotNull())) == [
        ("meta_municipio", "0000002", "O", "taxa_alfabetizacao"),
        (INTEGRATED_ENTITY, "0000013", "O", "municipio_inexistente"),
    ]


def staged_plans(monkeypatch):
    """Plans of what the jobs write, by table."""
    seen, stage = {}, layer_jobs.stage_layer

    def watched(df, path, entity, layer, run_ts, rebalance=True, routes=()):
        seen[entity, layer] = (plan(df), rebalance)
        return stage(df, path, entity, layer, run_ts, rebalance, routes)

    monkeypatch.setattr(layer_jobs, "stage_layer", watched)
    return seen


STUDENT = schema_for("alunos", "bronze", lineage=False)
NOW = datetime(2026, 7, 12, tzinfo=timezone.utc)


def test_finished_rows_are_not_exchanged(spark, monkeypatch):
    """loads are written where they were made."""
    seen = staged_plans(monkeypatch)
    run = Run(spark, Lake(work_folder(spark, "lake")), NOW)
    facts = spark.createDataFrame([(y, "0000001", "s", f"a{y}", "c", "2", "r", "P", None, "1", 800.0, 1.0) for y in (2023, 2024)], STUDENT)
    layer_jobs.bronze_job(run, facts, "alunos")
    silver_jobs(run, ["alunos"])
    text, again = seen["alunos", "bronze"]
    assert not again and "Exchange" not in text
    text, again = seen["alunos", "silver"]
    assert not again and text.count("Exchange") == 1
    assert run.bronze("alunos").count() == 2 and run.silver("alunos").count() == 2


def test_settled_events_are_not_settled_again(spark):
    """of settled events only types are mended before the merge."""
    flat = schema_for(EVENT_ENTITY, "bronze", lineage=False)
    events = spark.createDataFrame([("a", "t", "2024-01-01T00:00:00+00:00", "1", None, 2024, 5.0, None), (None, "t", None, "2", None, 2024, 6.0, None)], flat)
    municipio = spark.createDataFrame([("0000001", "RJ", "Rio", "Rio")], "id_municipio string, sigla_uf string, nome_municipio string, nome_uf string")
    meta_uf = spark.createDataFrame([("RJ", 2024, "r", 50.0)], "sigla_uf string, ano int, rede string, taxa_alfabetizacao double")
    batch = integrate.integrate_batch(
        spark.createDataFrame([], "id_municipio string, ano int, sigla_uf string, rede string, taxa_alfabetizacao double"), municipio, meta_uf
    )
    cleaned, settled = (integrate.merge_events(batch, events, municipio, meta_uf, one_per_id=known) for known in (False, True))
    assert rows(cleaned) == rows(settled) and len(rows(settled)) == 2
    assert plan(settled).count("Window [") < plan(cleaned).count("Window [")


def test_settling_writes_no_table_of_the_wave(spark, monkeypatch):
    """copies within and across batches meet in one pass."""
    log, settled, flat = work_folder(spark, "log"), work_folder(spark, "settled"), schema_for(EVENT_ENTITY, "bronze", lineage=False)

    def event(name, hour, rate):
        return (name, "t", f"2024-01-01T{hour:02}:00:00+00:00", "0000001", None, 2024, rate, None)

    for batch, wave in enumerate([[event("a", 1, 1.0), event("a", 3, 3.0), event(None, 1, 7.0)], [event("a", 2, 2.0), event("b", 1, 4.0), event("b", 1, 4.0)]]):
        spark.createDataFrame(wave, flat).write.parquet(f"{log}/batch_id={batch}")
    monkeypatch.setattr(streaming, "work_table", None, raising=False)
    found = streaming.settle_events(spark, log, settled, flat)
    assert rows(found, "event_id", "taxa_alfabetizacao") == [("a", 3.0), ("b", 4.0), (None, 7.0)]


def test_steps_side_by_side(spark):
    """all run, the first failure in order is raised, shuffle sizes do not undo each other."""
    before, done = spark.conf.get(INITIAL_PARTITIONS, None), []

    def step(name, partitions):
        with sized_shuffles(spark, partitions * SHUFFLE_BYTES):
            assert int(spark.conf.get(INITIAL_PARTITIONS)) >= partitions
            spark.range(10).groupBy("id").count().collect()
            assert int(spark.conf.get(INITIAL_PARTITIONS)) >= partitions
            done.append(name)
            if name == "bad":
                raise ValueError(name)
            return name

    assert side_by_side(spark, [lambda n=n: step(n, 10 * n) for n in range(1, 7)]) == [1, 2, 3, 4, 5, 6]
    with pytest.raises(ValueError, match="bad"):
        side_by_side(spark, [lambda n=n: step(n, 10) for n in ("bad", "good")])
    assert sorted(map(str, done)) == ["1", "2", "3", "4", "5", "6", "bad", "good"]
    assert spark.conf.get(INITIAL_PARTITIONS, None) == before


def test_dq_report_derives_the_municipal_targets_once(spark, monkeypatch):
    """a raw entity that several derivations read is stored."""
    from workload import data

    kept, store = [], data.materialise
    monkeypatch.setattr(data, "materialise", lambda df, label: kept.append(label) or store(df, label))
    day = datetime(1997, 3, 4)
    sf_dir = given_tables(
        spark,
        region=[(0, "NORTH")],
        nation=[(0, "NATION_0", 0)],
        customer=[(1, "Customer 1", 0, 1.0, "M")],
        orders=[(1, 1, "O", 100_000.0, day, "5-LOW")],
        lineitem=[(1, 1, 1, 1, 1.0, 100.0, 0.0, 0.0, "R", "O", day)],
        events=[(8, datetime(2024, 1, 2), 1, "click", 5.0, "{}")],
    )
    report = QUERIES["dq_report"](spark, sf_dir)
    assert report.count() == 70 and kept.count("fx_meta_municipio") == 1
