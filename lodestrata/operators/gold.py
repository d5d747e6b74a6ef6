"""Analytic views over the integrated table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.contracts import (
    REQUIRED_VIEW_COLUMNS,
    TARGET_PREFIX,
    ContractError,
    conform,
    conform_present,
    schema_for,
)
from lodestrata.functions.lineage import BATCH_SOURCE
from lodestrata.functions.numbers import exact_mean, round2
from lodestrata.functions.targets import with_target_gap
from lodestrata.operators.dedup import first_per_key
from lodestrata.operators.integrate import GRAIN

NAMES = ("nome_municipio", "sigla_uf", "nome_uf")


def base_rows(integrated: DataFrame) -> DataFrame:
    """Batch rows, or all rows where there are none; one per grain.

    Whether batch rows exist is a scalar subquery that stops at the first one found.
    """
    if "_source_type" in integrated.columns:
        is_batch = F.col("_source_type") == BATCH_SOURCE
        batch_found = integrated.where(is_batch).limit(1).agg(F.count(F.lit(1))).scalar()
        integrated = integrated.where(is_batch | (batch_found == 0))
    return first_per_key(integrated, GRAIN)


def _base(integrated: DataFrame, *attributes: str) -> DataFrame:
    """Base rows with target and gap. Only what a view needs is read, sorted and shuffled."""
    wanted = {*GRAIN, "_source_type", "taxa_alfabetizacao", *attributes}
    columns = [c for c in integrated.columns if c in wanted or c.startswith(TARGET_PREFIX)]
    return with_target_gap(base_rows(integrated.select(*columns)))


def student_totals(students: DataFrame) -> DataFrame:
    return students.groupBy("id_municipio", "ano").agg(F.count("id_aluno").alias("total_alunos_avaliados"))


def indicador_municipio(integrated: DataFrame, students: DataFrame | None = None) -> DataFrame:
    """Rate, target and gap of each municipality, year and network, with the number of students seen."""
    attributes = (*NAMES, "indicador_uf", "nivel_alfabetizacao", "percentual_participacao")
    view = _base(integrated, *attributes).withColumnsRenamed(
        {"nome_municipio": "nome", "taxa_alfabetizacao": "pct_alfabetizados", "meta_vigente": "meta_pct"}
    )
    if students is not None:
        # Counted before the join: one row per municipality and year meets the fact rows.
        view = view.join(student_totals(students), ["id_municipio", "ano"], "left")
    return conform_present(view, schema_for("indicador_municipio", "gold", lineage=False))


def with_dense_rank(df: DataFrame, group: str, value: str, rank: str) -> DataFrame:
    """Dense rank from the highest value down; a null value has no rank.

    Made for roll-ups: a group holds one row per state, not one per record.
    """
    window = Window.partitionBy(group).orderBy(F.col(value).desc_nulls_last())
    return df.withColumn(rank, F.when(F.col(value).isNotNull(), F.dense_rank().over(window)).cast("int"))


def meta_vs_resultado(integrated: DataFrame, uf: DataFrame | None = None) -> DataFrame:
    """Means, hits and misses per state and year, ranked within the year and compared with the year before."""
    hit = F.col("atingiu_meta")
    rollup = (
        _base(integrated, "sigla_uf")
        .groupBy("sigla_uf", "ano")
        .agg(
            round2(exact_mean(F.col("taxa_alfabetizacao"))).alias("taxa_media"),
            round2(exact_mean(F.col("meta_vigente"))).alias("meta_media"),
            round2(exact_mean(F.col("gap_meta"))).alias("gap_medio"),
            F.count_distinct("id_municipio").alias("municipios_total"),
            F.count_if(hit).alias("municipios_acima_meta"),
            F.count_if(~hit).alias("municipios_abaixo_meta"),
        )
    )
    by_year = Window.partitionBy("sigla_uf").orderBy(F.col("ano").asc_nulls_last())
    compared = with_dense_rank(rollup, "ano", "taxa_media", "ranking_taxa").withColumn(
        "taxa_anterior", F.lag("taxa_media").over(by_year)
    )
    view = compared.withColumn("delta_percentual", round2(F.col("taxa_media") - F.col("taxa_anterior")))
    if uf is not None and {"regiao", "nome_uf"} <= set(uf.columns):
        view = view.join(first_per_key(uf.select("sigla_uf", "regiao", "nome_uf"), ["sigla_uf"]), "sigla_uf", "left")
    return conform_present(view, schema_for("meta_vs_resultado", "gold", lineage=False))


def evolucao_temporal(integrated: DataFrame) -> DataFrame:
    """Change of each municipality and network against its previous year on record."""
    by_year = Window.partitionBy("id_municipio", "rede").orderBy(F.col("ano").asc_nulls_last())
    rate = F.col("taxa_alfabetizacao")
    before = F.lag(rate).over(by_year)
    view = (
        _base(integrated, *NAMES)
        .withColumn("pct_anterior", before)
        .withColumn("delta_percentual", round2(rate - F.col("pct_anterior")))
        .withColumn("delta_anual", F.col("delta_percentual"))
        .withColumnsRenamed(
            {"nome_municipio": "nome", "taxa_alfabetizacao": "pct_alfabetizados", "meta_vigente": "meta_pct"}
        )
    )
    return conform(view, schema_for("evolucao_temporal", "gold", lineage=False))


# --- Views that exist as declared contracts -----------------------------------------------------


def gold_alunos(students: DataFrame) -> DataFrame:
    """Students, literate students and their share per year and municipality.

    Counts are bigint: one municipality's students may not fit an int at scale.
    """
    counts = students.groupBy("ano", "id_municipio").agg(
        F.count("id_aluno").alias("total_alunos"),
        F.count_if(F.col("alfabetizado") == "1").alias("total_alfabetizados"),
    )
    share = F.try_divide(F.lit(100.0) * F.col("total_alfabetizados"), F.col("total_alunos").cast("double"))
    return counts.withColumn("taxa_alfabetizacao_calc", round2(share))


def gold_meta_brasil(meta_brasil: DataFrame) -> DataFrame:
    return conform(with_target_gap(meta_brasil), schema_for("meta_brasil", "gold", lineage=False))


def _with_network(view: DataFrame, entity: str) -> DataFrame:
    contract = schema_for(entity, "gold", lineage=False)
    return conform(view, contract.add("rede", "string"))


def gold_meta_uf(meta_uf: DataFrame) -> DataFrame:
    """One row per year, state and network; the network is a column beside those of the contract."""
    return _with_network(with_target_gap(meta_uf), "meta_uf")


def gold_meta_municipio(integrated: DataFrame) -> DataFrame:
    """Municipal targets with the yearly change, one row per municipality, year and network."""
    by_year = Window.partitionBy("id_municipio", "rede").orderBy(F.col("ano").asc_nulls_last())
    rate = F.col("taxa_alfabetizacao")
    view = _base(integrated, *NAMES).withColumn("delta_anual", round2(rate - F.lag(rate).over(by_year)))
    return _with_network(view, "meta_municipio")


def check_view(view: DataFrame, name: str) -> DataFrame:
    """The view itself, or an error when it lacks required columns or has no row."""
    missing = [c for c in REQUIRED_VIEW_COLUMNS[name] if c not in view.columns]
    if missing:
        raise ContractError(f"gold {name}: missing columns {', '.join(missing)}")
    if view.isEmpty():
        raise ContractError(f"gold {name}: no rows")
    return view


def view_contract(view: DataFrame, name: str) -> DataFrame:
    """The same checks as one report row."""
    complete = all(c in view.columns for c in REQUIRED_VIEW_COLUMNS[name])
    return view.limit(1).agg(
        F.lit(name).alias("visao"),
        F.lit(complete).alias("colunas_presentes"),
        (F.count(F.lit(1)) > 0).alias("tem_linhas"),
    )


VIEWS: dict[str, Callable[..., DataFrame]] = {
    "indicador_municipio": indicador_municipio,
    "meta_vs_resultado": meta_vs_resultado,
    "evolucao_temporal": evolucao_temporal,
}
