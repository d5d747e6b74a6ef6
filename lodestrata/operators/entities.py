"""Cleaning of each raw entity: E1 to E6 and the event entity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.contracts import BUSINESS_KEYS, EVENT_ENTITY, schema_for
from lodestrata.functions.lineage import drop_technical
from lodestrata.functions.numbers import lenient_double
from lodestrata.functions.targets import derived_flag, gap, reached, target_in_force
from lodestrata.functions.text import normalise_code, pad_key, text_key, title_name
from lodestrata.operators.dedup import first_per_key

LOADED_AT = "_ingestion_timestamp"


def _one_per_key(df: DataFrame, entity: str) -> DataFrame:
    """The newest load first, where the rows say when they were loaded; technical columns go."""
    newest = [F.col(LOADED_AT).desc_nulls_last()] if LOADED_AT in df.columns else []
    return drop_technical(first_per_key(df, BUSINESS_KEYS[entity], newest))


def _with_loaded_at(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns, *(c for c in (LOADED_AT,) if c in df.columns))


def project_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of the columns that the input has."""
    return df.select(*(c for c in columns if c in df.columns))


def clean_uf(df: DataFrame) -> DataFrame:
    named = df.withColumns(
        {
            "sigla_uf": normalise_code(F.col("sigla")),
            "nome_uf": title_name(F.col("nome")),
            "regiao": F.trim("regiao") if "regiao" in df.columns else F.lit(None).cast("string"),
        }
    )
    return _one_per_key(_with_loaded_at(named, ["id_uf", "sigla_uf", "nome_uf", "regiao"]), "uf")


def clean_municipio(df: DataFrame) -> DataFrame:
    named = df.withColumns(
        {
            "id_municipio": pad_key(F.col("id_municipio")),
            "sigla_uf": normalise_code(F.col("sigla_uf")),
            "nome_municipio": title_name(F.col("nome")),
            "nome_uf": F.trim("nome_uf") if "nome_uf" in df.columns else F.lit(None).cast("string"),
        }
    )
    columns = ["id_municipio", "sigla_uf", "nome_municipio", "nome_uf"]
    return _one_per_key(_with_loaded_at(named, columns), "municipio")


def clean_meta_brasil(df: DataFrame) -> DataFrame:
    return _one_per_key(df.withColumn("ano", F.col("ano").try_cast("int")), "meta_brasil")


def clean_meta_uf(df: DataFrame) -> DataFrame:
    typed = df.withColumns({"sigla_uf": normalise_code(F.col("sigla_uf")), "ano": F.col("ano").try_cast("int")})
    return _one_per_key(typed, "meta_uf")


def enrich_from_lookup(df: DataFrame, lookup: DataFrame, key: str, column: str) -> DataFrame:
    """Fills ``column`` from ``lookup`` where the row has none (or where ``df`` lacks the column)."""
    found = "_found"
    values = first_per_key(lookup.select(key, F.col(column).alias(found)).where(F.col(found).isNotNull()), [key])
    joined = df.join(values, key, "left")
    filled = F.coalesce(F.col(column), F.col(found)) if column in df.columns else F.col(found)
    return joined.withColumn(column, filled).drop(found)


def clean_meta_municipio(df: DataFrame, municipios: DataFrame | None = None) -> DataFrame:
    """``municipios`` is the clean directory that supplies missing state codes."""
    typed = df.withColumns({"id_municipio": pad_key(F.col("id_municipio")), "ano": F.col("ano").try_cast("int")})
    if "sigla_uf" in df.columns:
        typed = typed.withColumn("sigla_uf", normalise_code(F.col("sigla_uf")))
    if "nivel_alfabetizacao" in df.columns:
        typed = typed.withColumn("nivel_alfabetizacao", F.col("nivel_alfabetizacao").cast("string"))
    clean = _one_per_key(typed, "meta_municipio")
    if municipios is not None:
        clean = enrich_from_lookup(clean, municipios, "id_municipio", "sigla_uf")
    rate, in_force = F.col("taxa_alfabetizacao"), target_in_force(clean.columns)
    return clean.withColumns({"gap_meta": gap(rate, in_force), "atingiu_meta": reached(rate, in_force)})


def clean_alunos(df: DataFrame) -> DataFrame:
    score = lenient_double(F.col("proficiencia"))
    given = F.trim(F.col("alfabetizado").cast("string")) if "alfabetizado" in df.columns else F.lit(None)
    typed = df.withColumns(
        {
            "id_municipio": pad_key(F.col("id_municipio")),
            "id_aluno": text_key(F.col("id_aluno")),
            "proficiencia": score,
            "alfabetizado": derived_flag(given, score),
        }
    )
    if "id_escola" in df.columns:
        typed = typed.withColumn("id_escola", F.col("id_escola").cast("string"))
    if "peso_aluno" in df.columns:
        typed = typed.withColumn("peso_aluno", lenient_double(F.col("peso_aluno")))
    wanted = schema_for("alunos", "silver", lineage=False).fieldNames()
    return _one_per_key(project_present(typed, [*wanted, LOADED_AT]), "alunos")


def typed_events(df: DataFrame) -> DataFrame:
    """Events with padded keys and whole years, without technical columns."""
    return drop_technical(df.withColumns({"id_municipio": pad_key(F.col("id_municipio")), "ano": F.col("ano").try_cast("int")}))


def clean_events(df: DataFrame) -> DataFrame:
    """The newest state of each event, by event time."""
    return first_per_key(typed_events(df), ["event_id"], [event_time().desc_nulls_last()])


def event_time(column: str = "timestamp"):
    return F.col(column).try_cast("timestamp")


CLEANERS: dict[str, Callable[..., DataFrame]] = {
    "uf": clean_uf,
    "municipio": clean_municipio,
    "meta_brasil": clean_meta_brasil,
    "meta_uf": clean_meta_uf,
    "meta_municipio": clean_meta_municipio,
    "alunos": clean_alunos,
    EVENT_ENTITY: clean_events,
}
