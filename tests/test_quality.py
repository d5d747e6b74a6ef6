import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodestrata.contracts import EVENT_ENTITY
from lodestrata.operators import profile
from lodestrata.operators.quality import (
    QualityError,
    Rule,
    accepted,
    in_range,
    key_length,
    matches,
    min_count,
    not_null,
    quality_gate,
    quality_report,
    quality_reports,
    quarantine_split,
    rule_book,
    rules_for,
    unique,
    violates,
)


@pytest.fixture
def df(spark):
    data = [
        ("1", "0000001", 10.0),
        ("1", "0000002", 150.0),
        (None, "0000003\n", -1.0),
        (None, "123", None),
        ("2", None, 100.0),
    ]
    return spark.createDataFrame(data, "id string, k string, x double")


def measures(df, *rules):
    return [(r.check, r.aprovado, r.medida) for r in quality_report(df, rules).orderBy("ordem").collect()]


def test_report(df):
    assert measures(
        df,
        not_null("id"),
        unique("id"),
        matches("k", r"^\d{7}$"),
        in_range("x", 0, 100),
        in_range("x", minimum=0),
        in_range("x", maximum=100),
        min_count(5),
        min_count(6),
        accepted("id", ["1"]),
        key_length("k", 7),
    ) == [
        ("not_null:id", False, 2),
        ("unique:id", False, 2),  # 1 and null each once too often
        ("regex:k", False, 2),  # a trailing line break does not match, null is no case
        ("range:x", False, 2),
        ("range:x", False, 1),
        ("range:x", False, 1),
        ("min_count", True, 5),
        ("min_count", False, 5),
        ("accepted_values:id", False, 1),
        ("key_length:k", False, 2),
    ]


def test_a_single_null_is_one_value(spark):
    df = spark.createDataFrame([("a",), (None,)], "id string")
    assert measures(df, unique("id")) == [("unique:id", True, 0)]


def test_empty_table(df):
    assert measures(df.limit(0), not_null("id"), unique("id"), min_count(1)) == [
        ("not_null:id", True, 0),
        ("unique:id", True, 0),
        ("min_count", False, 0),
    ]


def test_report_is_one_pass(df):
    rules = [not_null("id"), unique("id"), matches("k", "x"), in_range("x", 0, 1), min_count(1)]
    text = quality_report(df, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") + text.count("LocalRelation") == 1


def test_gate(df, caplog):
    assert len(quality_gate(df, [min_count(1), not_null("x", critical=False)])) == 2
    assert "not_null:x" in caplog.text
    with pytest.raises(QualityError) as error:
        quality_gate(df, [not_null("id"), in_range("x", 0, 100), min_count(1), not_null("k", critical=False)])
    assert "not_null:id" in str(error.value) and "range:x" in str(error.value)
    assert "not_null:k" not in str(error.value) and "min_count" not in str(error.value)


def test_unknown_rule_fails(df):
    odd = Rule("sorted", "id", critical=False)
    assert measures(df, odd) == [("sorted:id", False, None)]
    with pytest.raises(QualityError, match="unknown rule: sorted"):
        quality_gate(df, [odd])
    with pytest.raises(QualityError, match="unknown rule"):
        quarantine_split(df, [Rule("sorted", "id")])
    with pytest.raises(ValueError):
        violates(odd)


def test_quarantine(df):
    rules = [
        not_null("id"),
        matches("k", r"^\d{7}$"),
        in_range("x", 0, 100),
        unique("id"),
        not_null("x", critical=False),
        min_count(99),
    ]
    valid, aside = quarantine_split(df, rules)
    assert rows(valid) == [("1", "0000001", 10.0)]
    assert rows(aside, "k", "_motivo_quarentena") == [
        ("0000002", "x;id"),
        ("0000003\n", "id;k;x"),
        ("123", "id;k;id"),  # null ids repeat each other; rule order and repeats are kept
        (None, "k"),  # a null breaks the pattern here
    ]


def test_quarantine_without_rules(df):
    valid, aside = quarantine_split(df, [])
    assert (valid.count(), aside.count()) == (5, 0)


def test_rule_book():
    assert len(rule_book()) == 21 and sum(map(len, rule_book().values())) == 70
    assert [r.label for r in rules_for("uf", "BRONZE")] == ["not_null:sigla", "unique:sigla", "regex:sigla", "min_count"]
    assert [r.label for r in rules_for(EVENT_ENTITY, "silver")] == ["not_null:event_id", "unique:event_id"]
    assert not rules_for("alunos", "silver")[2].critical
    fitted = rules_for("meta_brasil", "silver", last_year=2001)
    assert fitted[1].column == "meta_alfabetizacao_2001"


def test_profile(spark):
    df = spark.createDataFrame(
        [(2024, "1", None, 1.0, True), (2023, "1", "x", None, None), (2023, "1", "x", None, None)],
        "ano int, id_municipio string, coisa string, meta_alfabetizacao_2024 double, b boolean",
    )
    assert rows(profile.profile_table(df)) == [
        ("ano", "INTEGER", "chave", 0, 3),
        ("b", "BOOLEAN", "atributo", 2, 3),
        ("coisa", "STRING", "atributo", 1, 3),
        ("id_municipio", "STRING", "chave", 0, 3),
        ("meta_alfabetizacao_2024", "FLOAT", "meta", 2, 3),
    ]
    assert rows(profile.profile_years(df)) == [(2023,), (2024,)]
    assert rows(profile.profile_duplicate_keys(df)) == [("id_municipio,ano", 1)]
    assert rows(profile.profile_duplicate_keys(df.select("coisa"))) == [("", None)]
    assert rows(profile.profile_sample(df, 1), "ano", "coisa") == [(2023, "x")]
    assert rows(profile.completeness(df, ["coisa", "ano"], 0.7)) == [("ano", 1.0, True), ("coisa", 0.666667, False)]


def test_checks_between_tables(spark):
    one, two = spark.range(3), spark.range(3).unionAll(spark.range(3))
    assert rows(profile.reconcile_counts(one, two)) == [(3, 6, True, True)]
    assert rows(profile.reconcile_counts(two, one)) == [(6, 3, False, False)]
    assert rows(profile.reconcile_counts(one.limit(0), one)) == [(0, 3, False, False)]
    assert rows(profile.reconcile_value_sets(one, spark.range(2, 5), "id")) == [(2, 2, False)]
    assert rows(profile.reconcile_value_sets(one, two, "id")) == [(0, 0, True)]
    assert rows(profile.volume_check({"t": one, "u": two}, {"t": (1, 3), "u": (1, 3)})) == [
        ("t", 3, 1, 3, True),
        ("u", 6, 1, 3, False),
    ]
    assert rows(profile.key_is_unique(two, "id")) == [(6, 3, 0)]
    assert rows(profile.key_lengths(one.select(F.col("id").cast("string").alias("k")), "k", 1)) == [(0, 1)]


def test_stored_gap_tolerance(spark):
    df = spark.createDataFrame(
        [(50.0, 60.0, -10.0), (50.0, 60.0, -10.009), (50.0, 60.0, -10.02), (None, 60.0, -1.0)],
        "pct_alfabetizados double, meta_pct double, gap_meta double",
    )
    assert rows(profile.gap_is_consistent(df)) == [(1, 0)]


def test_dq_report_judges_every_rule_set():
    from workload.q_quality import BOOK

    assert set(BOOK) == set(rule_book())


def test_rule_sets_of_one_table_share_a_pass(spark, tmp_path):
    spark.createDataFrame([("1", 5), ("1", None), (None, 7)], "k string, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    sets = {("e", "silver"): [not_null("k"), unique("k")], ("e", "gold"): [min_count(4), not_null("k")], ("e", "none"): []}
    got = quality_reports(df, sets, ("entidade", "camada"))
    found = {(r.entidade, r.camada, r.ordem, r.check, r.aprovado, r.medida) for r in got.collect()}
    assert found == {
        ("e", "silver", 1, "not_null:k", False, 1),
        ("e", "silver", 2, "unique:k", False, 1),
        ("e", "gold", 1, "min_count", False, 3),
        ("e", "gold", 2, "not_null:k", False, 1),
    }
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
