from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodestrata.functions import events, lineage, numbers, targets, text

RUN_TS = datetime(2026, 7, 12, 23, 59, tzinfo=timezone.utc)


def test_codes_and_names(spark):
    df = spark.createDataFrame([("  sp ", " são-joão d'oeste "), (None, None)], "c string, n string")
    got = df.select(text.normalise_code(F.col("c")), text.title_name(F.col("n")))
    assert rows(got) == [("SP", "São-joão D'oeste"), (None, None)]


def test_short_code_of_empty_text_is_null(spark):
    df = spark.createDataFrame([("minas",), ("",), (None,)], "c string")
    assert rows(df.select(text.short_code(F.col("c")))) == [("MI",), (None,), (None,)]


def test_pad_key_keeps_long_keys(spark):
    df = spark.createDataFrame([("42",), ("1234567",), ("12345678",), (None,)], "k string")
    assert rows(df.select(text.pad_key(F.col("k")))) == [("0000042",), ("1234567",), ("12345678",), (None,)]


def test_round_half_up_on_the_decimal_value(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (1e15 + 0.5,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in df.select(numbers.round2(F.col("x"))).collect()]
    assert got[:4] == [1.01, 2.68, -1.01, 1e15 + 0.5]
    assert got[4] != got[4]
    assert got[5] is None


def test_mean_ignores_nulls_and_survives_any_value(spark):
    df = spark.createDataFrame(
        [("a", 0.1), ("a", 0.2), ("a", None), ("b", None), ("c", 1e20), ("c", 3e20)], "g string, x double"
    )
    assert rows(df.groupBy("g").agg(numbers.exact_mean(F.col("x")))) == [("a", 0.15), ("b", None), ("c", 2e20)]


def test_lenient_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("n/d",), ("",), ("NaN",), (None,)], "x string")
    assert [r[0] for r in df.select(numbers.lenient_double(F.col("x"))).collect()] == [1.5, None, None, None, None]


def test_clamp_percent(spark):
    df = spark.createDataFrame([(-3.0,), (55.555,), (491.02,), (None,)], "x double")
    assert [r[0] for r in df.select(numbers.clamp_percent(F.col("x"))).collect()] == [0.0, 55.56, 100.0, None]


@pytest.fixture
def yearly(spark):
    schema = (
        "ano int, taxa_alfabetizacao double, meta_alfabetizacao_2024 double, meta_alfabetizacao_2025 double,"
        " meta_alfabetizacao_2030 double"
    )
    data = [
        (2023, 50.0, 60.0, 65.0, 80.0),  # no column for the year: last year's target
        (2024, 60.0, 60.0, 65.0, 80.0),
        (2025, 70.0, 60.0, None, 80.0),  # own year unset: last year's target
        (2025, None, None, 65.0, None),
        (2024, 40.0, None, None, None),  # nothing known
    ]
    return spark.createDataFrame(data, schema)


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_target_variants(yearly):
    columns = yearly.columns
    assert values(yearly, targets.target_in_force(columns)) == [80.0, 60.0, 80.0, 65.0, None]
    assert values(yearly, targets.target_first_non_null(columns)) == [60.0, 60.0, 60.0, 65.0, None]
    assert values(yearly, targets.target_event_fallback(columns)) == [60.0, 60.0, 60.0, 65.0, 40.0]
    without_rate = [c for c in columns if c != "taxa_alfabetizacao"]
    assert values(yearly, targets.target_event_fallback(without_rate)) == [60.0, 60.0, 60.0, 65.0, 0.0]


def test_no_target_columns(spark):
    df = spark.createDataFrame([(2024, 1.0)], "ano int, taxa_alfabetizacao double")
    assert values(df, targets.target_in_force(df.columns)) == [None]
    assert values(df, targets.target_first_non_null(df.columns)) == [None]
    assert values(df, targets.target_event_fallback(df.columns)) == [1.0]


def test_gap_and_three_valued_hit(yearly):
    got = targets.with_target_gap(yearly).select("gap_meta", "atingiu_meta").collect()
    assert [tuple(r) for r in got] == [(-30.0, False), (0.0, True), (-10.0, False), (None, None), (None, None)]


def test_derived_flag(spark):
    data = [(None, 743.0), (None, 742.99), (None, None), ("1", 0.0), ("Sim", None)]
    df = spark.createDataFrame(data, "f string, s double")
    assert values(df, targets.derived_flag(F.col("f"), F.col("s"))) == ["1", "0", "0", "1", "Sim"]


def test_fingerprint_skips_technical_columns_and_nulls(spark):
    import hashlib

    df = spark.createDataFrame([("a", None, 3, "x")], "p string, q string, r int, _t string")
    assert values(df, lineage.fingerprint(df.columns)) == [hashlib.md5(b"a||3").hexdigest()]


def test_bronze_rows_of_directories_carry_the_load_year(spark):
    directory = lineage.bronze_rows(spark.createDataFrame([("SP",)], "sigla string"), "uf", RUN_TS).first()
    assert (directory.ano, directory.mes, directory.dia, directory._source_entity) == ("2026", "07", "12", "uf")
    assert directory._ingestion_date == "2026-07-12" and directory._job_name == lineage.BATCH_JOB
    facts = lineage.bronze_rows(spark.createDataFrame([(2024,)], "ano int"), "meta_brasil", RUN_TS).first()
    assert facts.ano == 2024 and (facts.mes, facts.dia) == ("07", "12")


def test_events_survive_the_wire(spark):
    flat = spark.createDataFrame(
        [
            ("e1", "medicao_nova", "2026-07-12T10:00:00+00:00", "0000042", None, 2024, 0.1 + 0.2, 80.0),
            ("e2", "meta_revisada", "2026-07-12T11:00:00+00:00", "3550308", "SP", 2024, 55.5, None),
        ],
        "event_id string, event_type string, timestamp string, id_municipio string, sigla_uf string, ano int,"
        " taxa_alfabetizacao double, meta double",
    )
    wire = events.encode_events(flat)
    assert wire.columns == ["key", "value"] and values(wire, "key") == ["0000042", "3550308"]
    assert '"sigla_uf":null' in values(wire, "value")[0]
    binary = wire.withColumn("value", F.col("value").cast("binary"))
    assert rows(events.decode_events(binary)) == rows(flat)


def test_broken_json_gives_nulls(spark):
    wire = spark.createDataFrame([("k", "{oops")], "key string, value string")
    assert events.decode_events(wire).first().event_id is None
