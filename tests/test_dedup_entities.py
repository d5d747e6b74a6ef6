from conftest import plan, rows
from pyspark.sql import functions as F

from lodestrata.operators import dedup, entities


def test_first_per_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 1).alias("k"), (F.col("id") % 7).alias("v"))
    one = dedup.first_per_key(df, ["k"], [F.col("v").desc()])
    assert rows(one) == [(0, 6)]
    text = plan(one)
    assert text.index("Partial") > text.index("Exchange")  # printed from the top: below the exchange


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, v int")
    assert rows(dedup.first_per_key(df, ["k"])) == [("a", 3), (None, 1)]


def test_latest_snapshot(spark):
    df = spark.createDataFrame(
        [("a", 1, "2026-07-11"), ("a", 2, "2026-07-12"), ("b", 3, "2026-07-11")],
        "k string, v int, _ingestion_timestamp string",
    )
    assert rows(dedup.latest_snapshot(df, ["k"]), "k", "v") == [("a", 2), ("b", 3)]


def test_mark_repeats_leaves_one_of_every_key(spark):
    # A hot key spread over all partitions, full copies among its rows, and null keys.
    hot = spark.range(900).select(F.lit("hot").alias("k"), (F.col("id") % 3).alias("v"))
    rest = spark.createDataFrame([("a", 1), ("b", 1), ("b", 0), (None, 5), (None, 5)], "k string, v bigint")
    df = hot.unionByName(rest).repartition(8)
    marked = dedup.mark_repeats(df, "k", "again")
    assert marked.count() == 905
    assert rows(marked.where(~F.col("again")), "k", "v") == [("a", 1), ("b", 0), ("hot", 0), (None, 5)]
    assert marked.columns == ["k", "v", "again"]


def test_clean_directories(spark):
    uf = spark.createDataFrame(
        [("35", " sp ", " são paulo ", "sudeste "), ("99", "SP", "outra", "x")],
        "id_uf string, sigla string, nome string, regiao string",
    )
    assert rows(entities.clean_uf(uf)) == [("35", "SP", "São Paulo", "sudeste")]
    municipio = spark.createDataFrame(
        [(42, "mg ", " belo vale"), (42, "MG", "zz"), (12345678, "SP", "longo")],
        "id_municipio int, sigla_uf string, nome string",
    )
    assert rows(entities.clean_municipio(municipio)) == [
        ("0000042", "MG", "Belo Vale", None),
        ("12345678", "SP", "Longo", None),
    ]


def test_newest_load_wins(spark):
    df = spark.createDataFrame(
        [("1", "sp", "velho", "r", "2026-07-11", "j"), ("1", "sp", "novo", "r", "2026-07-12", "j")],
        "id_uf string, sigla string, nome string, regiao string, _ingestion_timestamp string, _job_name string",
    )
    assert rows(entities.clean_uf(df)) == [("1", "SP", "Novo", "r")]


META = "ano int, id_municipio string, rede string, taxa_alfabetizacao double, meta_alfabetizacao_2024 double, meta_alfabetizacao_2030 double"


def test_clean_meta_municipio_looks_up_the_state(spark):
    facts = spark.createDataFrame([(2024, "7", "P", 50.0, 60.0, 80.0), (2023, "8", "P", None, 60.0, 80.0)], META)
    directory = spark.createDataFrame([("0000007", "SP")], "id_municipio string, sigla_uf string")
    got = entities.clean_meta_municipio(facts, directory)
    assert rows(got, "id_municipio", "sigla_uf", "gap_meta", "atingiu_meta") == [
        ("0000007", "SP", -10.0, False),
        ("0000008", None, None, None),
    ]


def test_own_state_code_comes_before_the_directory(spark):
    facts = spark.createDataFrame([(2024, "7", " rj", 1.0), (2025, "7", None, 1.0)], "ano int, id_municipio string, sigla_uf string, taxa_alfabetizacao double")
    facts = facts.withColumn("rede", F.lit("P"))
    directory = spark.createDataFrame([("0000007", "SP")], "id_municipio string, sigla_uf string")
    assert rows(entities.clean_meta_municipio(facts, directory), "ano", "sigla_uf") == [(2024, "RJ"), (2025, "SP")]


def test_clean_alunos(spark):
    df = spark.createDataFrame(
        [
            (2024, "1", "e", " a1 ", "2", "P", None, "743", "1"),
            (2024, "1", "e", "a1", "2", "P", None, "743", "1"),  # same student, same year
            (2023, "1", "e", "a1", "2", "P", None, "n/d", "x"),  # same student, other year
            (2024, "1", "e", "a2", "2", "P", " 1 ", "10", "2.5"),
        ],
        "ano int, id_municipio string, id_escola string, id_aluno string, serie string, rede string,"
        " alfabetizado string, proficiencia string, peso_aluno string",
    ).withColumn("caderno", F.lit("c"))
    got = entities.clean_alunos(df)
    assert len(got.columns) == 9 and "caderno" not in got.columns
    assert rows(got, "id_aluno", "ano", "alfabetizado", "proficiencia", "peso_aluno") == [
        ("a1", 2023, "0", None, None),
        ("a1", 2024, "1", 743.0, 1.0),
        ("a2", 2024, "1", 10.0, 2.5),
    ]


def test_latest_event_wins(spark):
    df = spark.createDataFrame(
        [
            ("e1", "2026-07-12T10:00:00+00:00", "42", 2024, 1.0),
            ("e1", "2026-07-12T09:30:00-03:00", "42", 2024, 2.0),  # 12:30 UTC
            ("e2", "not a time", "42", 2024, 3.0),
        ],
        "event_id string, timestamp string, id_municipio string, ano int, taxa_alfabetizacao double",
    )
    got = entities.clean_events(df)
    assert rows(got, "event_id", "id_municipio", "taxa_alfabetizacao") == [
        ("e1", "0000042", 2.0),
        ("e2", "0000042", 3.0),
    ]
