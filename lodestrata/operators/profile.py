"""Profiles of a table and checks between tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.contracts import TARGET_PREFIX
from lodestrata.functions.numbers import far_apart
from lodestrata.functions.lineage import STREAM_SOURCE

# The part each column plays in the model, and the keys a table may be identified by
COLUMN_ROLES = {
    "ano": "chave",
    "sigla_uf": "chave",
    "id_municipio": "chave",
    "id_aluno": "chave",
    "id_escola": "chave",
    "rede": "dimensao",
    "serie": "dimensao",
    "presenca": "dimensao",
    "preenchimento_caderno": "dimensao",
    "caderno": "dimensao",
    "nome": "dimensao",
    "nome_uf": "dimensao",
    "nome_municipio": "dimensao",
    "taxa_alfabetizacao": "resultado",
    "media_portugues": "resultado",
    "proficiencia": "resultado",
    "alfabetizado": "resultado",
    "peso_aluno": "resultado",
    "percentual_participacao": "resultado",
    "nivel_alfabetizacao": "resultado",
}
PREFIX_ROLES = {TARGET_PREFIX: "meta", "proporcao_aluno_nivel_": "indicador"}
CANDIDATE_KEYS = ("id_municipio", "sigla_uf", "ano", "rede", "serie", "id_aluno")
TYPE_NAMES = {
    "tinyint": "INTEGER",
    "smallint": "INTEGER",
    "int": "INTEGER",
    "bigint": "INTEGER",
    "float": "FLOAT",
    "double": "FLOAT",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "TIMESTAMP",
}


def column_role(name: str) -> str:
    if name in COLUMN_ROLES:
        return COLUMN_ROLES[name]
    return next((role for prefix, role in PREFIX_ROLES.items() if name.startswith(prefix)), "atributo")


def profile_table(df: DataFrame) -> DataFrame:
    """Type, role and number of nulls of each column, and the number of rows; one pass, whole table."""
    nulls = [F.count_if(F.col(name).isNull()).alias(f"n{i}") for i, name in enumerate(df.columns)]
    measured = df.agg(F.count(F.lit(1)).alias("total_linhas"), *nulls)
    rows = [
        F.struct(
            F.lit(name).alias("nome"),
            F.lit(TYPE_NAMES.get(kind, "STRING")).alias("tipo"),
            F.lit(column_role(name)).alias("papel"),
            F.col(f"n{i}").alias("nulos"),
            F.col("total_linhas"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return measured.select(F.inline(F.array(*rows)))


def profile_years(df: DataFrame) -> DataFrame:
    return df.where(F.col("ano").isNotNull()).select("ano").distinct().orderBy("ano")


def profile_duplicate_keys(df: DataFrame, candidates: Sequence[str] = CANDIDATE_KEYS) -> DataFrame:
    """Rows beyond the first of each combination of those candidate keys that the table has."""
    keys = [name for name in candidates if name in df.columns]
    if not keys:
        return df.limit(1).agg(F.lit("").alias("chaves"), F.lit(None).cast("bigint").alias("duplicatas"))
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeats = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return groups.agg(F.lit(",".join(keys)).alias("chaves"), repeats.cast("bigint").alias("duplicatas"))


def profile_sample(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows in the order of all columns, so that the sample is always the same."""
    return df.orderBy(*(F.col(name).asc_nulls_last() for name in df.columns)).limit(n)


def completeness(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """Share of non-null values per column, and whether it reaches the threshold."""
    shares = [F.avg(F.col(name).isNotNull().cast("int")).alias(f"s{i}") for i, name in enumerate(columns)]
    rows = [
        F.struct(
            F.lit(name).alias("coluna"),
            F.round(F.col(f"s{i}").cast("decimal(18,8)"), 6).cast("double").alias("completude"),
            (F.col(f"s{i}") >= threshold).alias("aprovado"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*shares).select(F.inline(F.array(*rows)))


def volume_check(tables: dict[str, DataFrame], bands: dict[str, tuple[int, int]]) -> DataFrame:
    """Row count of each table against its band."""
    counts = [
        table.agg(
            F.lit(name).alias("tabela"),
            F.count(F.lit(1)).alias("total"),
            F.lit(bands[name][0]).cast("bigint").alias("minimo"),
            F.lit(bands[name][1]).cast("bigint").alias("maximo"),
        )
        for name, table in tables.items()
    ]
    within = F.col("total").between(F.col("minimo"), F.col("maximo"))
    return reduce(DataFrame.unionByName, counts).withColumn("aprovado", within)


def key_is_unique(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, and 1 where they agree (a null key is counted as a row, not as a key)."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.count_distinct(key).alias("distintos"))
    return counts.withColumn("valor", F.when(F.col("total") == F.col("distintos"), 1).otherwise(0))


def no_orphans(integrated: DataFrame) -> DataFrame:
    counts = integrated.agg(F.count_if(F.col("nome_municipio").isNull()).alias("orfaos"))
    return counts.withColumn("valor", F.when(F.col("orfaos") == 0, 1).otherwise(0))


def gap_is_consistent(indicador_municipio: DataFrame) -> DataFrame:
    """Rows whose stored gap is off by more than 0.01; rows without rate or target do not count."""
    off = far_apart(F.col("gap_meta"), F.col("pct_alfabetizados") - F.col("meta_pct"))
    counts = indicador_municipio.agg(F.count_if(off).alias("inconsistentes"))
    return counts.withColumn("valor", F.when(F.col("inconsistentes") == 0, 1).otherwise(0))


def stream_present(integrated: DataFrame) -> DataFrame:
    counts = integrated.agg(F.count_if(F.col("_source_type") == STREAM_SOURCE).alias("n"))
    return counts.withColumn("valor", F.when(F.col("n") > 0, 1).otherwise(0))


def key_lengths(df: DataFrame, key: str, length: int) -> DataFrame:
    counts = df.agg(F.count_if(F.length(key) != length).alias("fora_do_tamanho"))
    return counts.withColumn("valor", F.when(F.col("fora_do_tamanho") == 0, 1).otherwise(0))


def reconcile_counts(staged: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored rows hold the staged rows a whole number of times: once per load."""
    tagged = staged.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
        stored.select(F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    counts = tagged.agg(F.count_if(F.col("a") == 1).alias("origem"), F.count_if(F.col("b") == 1).alias("destino"))
    whole = F.coalesce(F.try_mod(F.col("destino"), F.col("origem")) == 0, F.lit(False))
    return counts.withColumns(
        {"multiplo": whole, "aprovado": whole & (F.col("destino") >= F.col("origem"))}
    )


def reconcile_value_sets(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """How many distinct values only one side has; equal sets give 0 and 0."""
    tagged = left.select(column, F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
        right.select(column, F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    sides = tagged.groupBy(column).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    counts = sides.agg(
        F.count_if(F.col("b") == 0).alias("so_esquerda"), F.count_if(F.col("a") == 0).alias("so_direita")
    )
    return counts.withColumn("iguais", (F.col("so_esquerda") == 0) & (F.col("so_direita") == 0))
