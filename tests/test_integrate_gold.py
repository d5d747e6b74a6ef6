import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lodestrata.contracts import ContractError, schema_for
from lodestrata.operators import analysis, gold, integrate

FACT = (
    "ano int, id_municipio string, sigla_uf string, rede string, taxa_alfabetizacao double,"
    " meta_alfabetizacao_2024 double, meta_alfabetizacao_2030 double"
)


@pytest.fixture
def facts(spark):
    data = [
        (2023, "0000001", "SP", "P", 50.0, 60.0, 80.0),
        (2024, "0000001", "SP", "P", 61.0, 60.0, 80.0),
        (2024, "0000002", "RJ", "P", 40.0, 60.0, 80.0),  # directory says SP
        (2024, "0000003", None, "P", 40.0, 60.0, 80.0),  # own code unknown
        (2024, "0000009", "SP", "P", 40.0, 60.0, 80.0),  # not in the directory
    ]
    return spark.createDataFrame(data, FACT)


@pytest.fixture
def municipio(spark):
    data = [(f"000000{i}", "SP", f"Nome {i}", "São Paulo") for i in (1, 2, 3)]
    return spark.createDataFrame(data + data[:1], "id_municipio string, sigla_uf string, nome_municipio string, nome_uf string")


@pytest.fixture
def meta_uf(spark):
    data = [("SP", 2024, "P", 70.0), ("SP", 2024, "E", 71.0), ("SP", 2023, "P", 69.0), (None, 2024, "P", 1.0)]
    return spark.createDataFrame(data, "sigla_uf string, ano int, rede string, taxa_alfabetizacao double")


def test_directories_cannot_multiply_rows(facts, municipio, meta_uf):
    got = integrate.integrate_batch(facts, municipio, meta_uf)
    assert rows(got, "id_municipio", "ano", "sigla_uf", "indicador_uf") == [
        ("0000001", 2023, "SP", 69.0),
        ("0000001", 2024, "SP", 71.0),  # network E comes first by name
        ("0000002", 2024, "RJ", None),
        ("0000003", 2024, None, None),  # a null key matches nothing
        ("0000009", 2024, "SP", 71.0),
    ]


def test_state_code_comes_from_the_directory_where_the_facts_have_none(facts, municipio, meta_uf):
    got = integrate.integrate_batch(facts.drop("sigla_uf"), municipio, meta_uf)
    assert rows(got.where("id_municipio = '0000002'"), "sigla_uf", "indicador_uf") == [("SP", 71.0)]


def test_referential_reasons(facts, municipio, meta_uf):
    batch = integrate.integrate_batch(facts, municipio, meta_uf)
    valid, aside = integrate.referential_split(batch)
    assert rows(aside, "id_municipio", "_motivo_quarentena") == [
        ("0000002", "uf_inconsistente"),
        ("0000009", "municipio_inexistente"),
    ]
    assert valid.count() == 3 and "_motivo_quarentena" not in valid.columns
    strict = integrate.referential_split(batch, null_is_mismatch=True)[1]
    assert rows(strict, "id_municipio") == [("0000002",), ("0000003",), ("0000009",)]


def test_orphans_and_matched(facts, municipio, meta_uf):
    assert rows(integrate.orphans(facts, municipio), "id_municipio") == [("0000009",)]
    assert integrate.matched(facts, municipio).count() == 4
    present, missing = integrate.split_orphans(integrate.integrate_batch(facts, municipio, meta_uf))
    assert (present.count(), missing.count()) == (4, 1)


EVENT = "event_id string, event_type string, timestamp string, id_municipio string, sigla_uf string, ano int, taxa_alfabetizacao double, meta double"


@pytest.fixture
def events(spark):
    def event(id_, hour, key, rate, code=None):
        return (id_, "medicao_nova", f"2026-07-12T{hour:02d}:00:00+00:00", key, code, 2024, rate, 80.0)

    data = [
        event("e1", 10, "1", 62.0),
        event("e1", 11, "1", 63.0),  # newer state of e1
        event("e2", 9, "1", 64.0),  # earlier event of the same municipality and year
        event("e3", 10, "77", 65.0, "SP"),  # municipality unknown, code given
    ]
    return spark.createDataFrame(data, EVENT)


@pytest.mark.parametrize(
    "network,expected",
    [
        # a network of its own: batch rows stay
        ("total", [("P", "batch", 61.0, None), ("total", "streaming", 63.0, "e1")]),
        # the batch rows' network: the latest event takes their place
        ("P", [("P", "streaming", 63.0, "e1")]),
    ],
)
def test_events_over_batch(facts, municipio, meta_uf, events, network, expected):
    valid = integrate.referential_split(integrate.integrate_batch(facts, municipio, meta_uf))[0]
    merged = integrate.merge_events(valid, events, municipio, meta_uf, network)
    one = merged.where("id_municipio = '0000001' AND ano = 2024")
    assert rows(one, "rede", "_source_type", "taxa_alfabetizacao", "event_id") == expected
    assert rows(one.where("event_id IS NOT NULL"), "sigla_uf", "nome_municipio", "indicador_uf") == [
        ("SP", "Nome 1", 71.0)
    ]
    stranger = merged.where("id_municipio = '0000077'")
    assert rows(stranger, "sigla_uf", "nome_municipio", "indicador_uf") == [("SP", None, 71.0)]


def test_no_events_leaves_the_batch(facts, municipio, meta_uf, events):
    valid = integrate.referential_split(integrate.integrate_batch(facts, municipio, meta_uf))[0]
    assert integrate.merge_events(valid, events.limit(0), municipio, meta_uf).count() == valid.count()


@pytest.fixture
def integrated(facts, municipio, meta_uf):
    return integrate.integrate_batch(facts, municipio, meta_uf)


def test_base_rows(integrated):
    batch = integrated.where("ano = 2023")
    streaming = integrated.where("ano = 2024").withColumn("_source_type", F.lit("streaming"))
    assert rows(gold.base_rows(batch.unionByName(streaming)), "ano") == [(2023,)]
    assert gold.base_rows(streaming.unionByName(streaming)).count() == 4
    assert gold.base_rows(integrated.drop("_source_type")).count() == 5


def test_municipality_view(integrated, spark):
    students = spark.createDataFrame(
        [("0000001", 2024, "a"), ("0000001", 2024, "b"), ("0000001", 2024, None)],
        "id_municipio string, ano int, id_aluno string",
    )
    view = gold.indicador_municipio(integrated, students)
    assert view.columns == schema_for("indicador_municipio", "gold", lineage=False).fieldNames()
    columns = ["id_municipio", "ano", "meta_pct", "gap_meta", "atingiu_meta", "total_alunos_avaliados"]
    assert rows(view.where("id_municipio = '0000001'"), *columns) == [
        ("0000001", 2023, 80.0, -30.0, False, None),
        ("0000001", 2024, 60.0, 1.0, True, 2),
    ]
    assert rows(gold.indicador_municipio(integrated), "total_alunos_avaliados")[0] == (None,)


def test_state_view(spark):
    data = [
        (2023, "1", "SP", "P", 50.0, None, 60.0, "batch"),
        (2024, "1", "SP", "P", 61.0, 60.0, 60.0, "batch"),
        (2024, "2", "SP", "P", 59.0, 60.0, 60.0, "batch"),
        (2024, "3", "SP", "P", None, 60.0, 60.0, "batch"),  # neither hit nor miss
        (2024, "4", "RJ", "P", 60.0, 60.0, 60.0, "batch"),
        (2024, "5", "AC", "P", None, None, None, "batch"),
        (2024, "6", None, "P", 10.0, 60.0, 60.0, "batch"),  # null is a group of its own
        (2024, "1", "SP", "P", 99.0, 60.0, 60.0, "streaming"),
    ]
    df = spark.createDataFrame(data, FACT + ", _source_type string")
    uf = spark.createDataFrame([("SP", "Sudeste", "São Paulo")] * 2, "sigla_uf string, regiao string, nome_uf string")
    view = gold.meta_vs_resultado(df, uf)
    columns = [
        "sigla_uf", "ano", "taxa_media", "gap_medio", "municipios_total", "municipios_acima_meta",
        "municipios_abaixo_meta", "ranking_taxa", "taxa_anterior", "delta_percentual", "regiao",
    ]
    assert rows(view, *columns) == [
        ("AC", 2024, None, None, 1, 0, 0, None, None, None, None),
        ("RJ", 2024, 60.0, 0.0, 1, 1, 0, 1, None, None, None),
        ("SP", 2023, 50.0, -10.0, 1, 0, 1, 1, None, None, "Sudeste"),
        ("SP", 2024, 60.0, 0.0, 3, 1, 1, 1, 50.0, 10.0, "Sudeste"),
        (None, 2024, 10.0, -50.0, 1, 0, 1, 2, None, None, None),
    ]
    assert rows(analysis.ranking_latest_year(view), "sigla_uf", "ranking_taxa")[0] == ("AC", None)
    assert analysis.national_hit_totals(view).collect() == [(2, 2)]
    assert rows(analysis.top_improvers(view), "sigla_uf", "delta_percentual") == [("SP", 10.0)]


def test_yearly_change_uses_the_previous_year_on_record(spark):
    data = [(y, "1", "SP", n, r, None, 60.0, "batch") for y, n, r in [(2020, "P", 10.0), (2023, "P", 15.5), (2024, "P", None), (2023, "E", 9.0)]]
    df = spark.createDataFrame(data, FACT + ", _source_type string").withColumns(
        {"nome_municipio": F.lit("n"), "nome_uf": F.lit("u")}
    )
    view = gold.evolucao_temporal(df)
    assert rows(view, "rede", "ano", "pct_anterior", "delta_percentual", "delta_anual") == [
        ("E", 2023, None, None, None),
        ("P", 2020, None, None, None),
        ("P", 2023, 10.0, 5.5, 5.5),
        ("P", 2024, 15.5, None, None),
    ]
    assert rows(analysis.national_evolution(view)) == [(2020, 10.0), (2023, 12.25), (2024, None)]
    assert rows(gold.gold_meta_municipio(df), "ano", "delta_anual") == [(2020, None), (2023, 5.5), (2023, None), (2024, None)]


def test_top_gaps_are_planned_as_a_top_k(integrated):
    top = analysis.top_negative_gap(gold.indicador_municipio(integrated), 2)
    assert rows(top, "id_municipio", "gap_meta") == [("0000001", -30.0), ("0000002", -20.0)]
    assert "TakeOrderedAndProject" in plan(top)


def test_student_view(spark):
    data = [("1", 2024, str(i), "1" if i < 2 else "0") for i in range(3)]
    df = spark.createDataFrame(data, "id_municipio string, ano int, id_aluno string, alfabetizado string")
    assert rows(gold.gold_alunos(df)) == [(2024, "1", 3, 2, 66.67)]


def test_view_contract(integrated):
    view = gold.indicador_municipio(integrated)
    assert gold.check_view(view, "indicador_municipio") is view
    with pytest.raises(ContractError, match="no rows"):
        gold.check_view(view.limit(0), "indicador_municipio")
    with pytest.raises(ContractError, match="gap_meta"):
        gold.check_view(view.drop("gap_meta"), "indicador_municipio")
    assert gold.view_contract(view.limit(0), "indicador_municipio").collect() == [("indicador_municipio", True, False)]


def test_hot_keys_do_not_reach_one_task(integrated):
    """The roll-up counts distinct municipalities in steps; only merged partial results are shuffled by state."""
    text = plan(gold.meta_vs_resultado(integrated))
    assert "partial_count(distinct id_municipio" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
