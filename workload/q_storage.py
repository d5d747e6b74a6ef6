"""Sources and sinks: every query reads back what it wrote."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.contracts import LINEAGE, partition_columns, schema_for, stored_schema, struct_of
from lodestrata.functions.lineage import bronze_rows, stamp
from lodestrata.operators import entities, gold
from lodestrata.operators.quality import in_range, quarantine_split
from lodestrata.session import materialise
from lodestrata.sources.catalog import register_table
from lodestrata.sources.sinks import write_layer
from lodestrata.sources.tables import loads, optional_scan, scan, scan_load, scan_loads, stored_or
from workload.data import EARLIER_TS, RUN_TS, Data
from workload.fixtures import TARGETS, YEARS
from workload.oracle import STUDENTS_TYPED
from workload.registry import query

T = ", ".join(TARGETS)


def store_twice(d: Data, df: DataFrame, entity: str, runs: Sequence[datetime]) -> DataFrame:
    """Loads of two days, the second one written twice: a repeated load replaces itself only."""
    path = d.folder(f"bronze-{entity}")
    columns = schema_for(entity, "bronze", YEARS, lineage=False).fieldNames()
    for run_ts in (*runs, runs[-1]):
        write_layer(bronze_rows(df.select(*columns), entity, run_ts), path, entity, "bronze", run_ts)
    return scan_loads(d.spark, path, stored_schema(entity, "bronze", YEARS))


FACTS = f"ano, id_municipio, rede, taxa_alfabetizacao, {T}, nivel_alfabetizacao, percentual_participacao"


@query(f"""SELECT {FACTS}, '2026-07-12' AS carga, '07' AS mes, '12' AS dia FROM {{fx_meta_municipio}}
UNION ALL SELECT {FACTS}, '2026-07-11', '07', '11' FROM {{fx_meta_municipio}}""")
def scan_partitioned(d: Data):
    """Two trees read as one table, partition values back as text."""
    paths = []
    for run_ts in (RUN_TS, EARLIER_TS):
        rows = bronze_rows(d.raw("fx_meta_municipio").drop("sigla_uf"), "meta_municipio", run_ts)
        paths.append(write_layer(rows, d.folder("scan"), "meta_municipio", "bronze", run_ts))
    both = reduce(DataFrame.unionByName, (scan_loads(d.spark, p, stored_schema("meta_municipio", "bronze", YEARS)) for p in paths))
    return both.drop(*struct_of(LINEAGE["bronze"]).fieldNames())


@query("""SELECT 'presente' AS origem, id_uf, sigla, nome, regiao FROM {fx_uf}""")
def optional_source(d: Data):
    path, schema = d.folder("optional"), schema_for("uf", "bronze", lineage=False)
    d.raw("fx_uf").write.parquet(path)
    present = optional_scan(d.spark, path, schema).withColumn("origem", F.lit("presente"))
    absent = optional_scan(d.spark, f"{path}-absent", schema).withColumn("origem", F.lit("ausente"))
    return present.unionByName(absent)


@query("SELECT 'silver' AS origem, * FROM {municipio} UNION ALL SELECT 'bronze', * FROM {municipio}")
def fallback_source(d: Data):
    schema = schema_for("municipio", "silver", lineage=False)
    silver, bronze = d.folder("silver"), d.folder("bronze")
    d.municipio.write.parquet(silver)
    d.raw("fx_municipio").write.parquet(bronze)

    def derive() -> DataFrame:
        return entities.clean_municipio(scan(d.spark, bronze, schema_for("municipio", "bronze", lineage=False)))

    stored = stored_or(lambda: scan(d.spark, silver, schema), derive)
    derived = stored_or(lambda: scan(d.spark, f"{silver}-absent", schema), derive)
    return stored.select(F.lit("silver").alias("origem"), "*").unionByName(
        derived.select(F.lit("bronze").alias("origem"), "*")
    )


@query(f"""SELECT {FACTS}, strftime(TIMESTAMP '2026-07-11' + INTERVAL (d) DAY, '%d') AS dia, '07' AS mes,
strftime(TIMESTAMP '2026-07-11' + INTERVAL (d) DAY, '%Y-%m-%d') AS carga
FROM {{fx_meta_municipio}}, (SELECT unnest([0, 1]) AS d)""")
def sink_overwrite_roundtrip(d: Data):
    stored = store_twice(d, d.raw("fx_meta_municipio"), "meta_municipio", (EARLIER_TS, RUN_TS))
    return stored.drop(*struct_of(LINEAGE["bronze"]).fieldNames())


@query("""SELECT *, '2026-07-12' AS carga, '2026' AS ano, '07' AS mes, '12' AS dia FROM {municipio}""")
def sink_silver_roundtrip(d: Data):
    path = d.folder("silver")
    write_layer(stamp(d.municipio, "silver", RUN_TS), path, "municipio", "silver", RUN_TS)
    return scan_loads(d.spark, path, stored_schema("municipio", "silver")).drop("_silver_processed_at").withColumn(
        "ano", F.col("ano").cast("string")
    )


@query(f"""SELECT *, 'proficiencia' AS _motivo_quarentena, '2026-07-12' AS carga, '07' AS mes, '12' AS dia FROM ({STUDENTS_TYPED})
WHERE proficiencia < 0 OR proficiencia > 1000""")
def sink_quarantine_roundtrip(d: Data):
    path = d.folder("quarentena")
    set_aside = quarantine_split(d.students_typed, [in_range("proficiencia", 0, 1000)])[1]
    write_layer(set_aside, path, "alunos", "silver", RUN_TS)
    schema = stored_schema("alunos", "silver", lineage=False).add("_motivo_quarentena", "string")
    return scan_loads(d.spark, path, schema)


@query("SELECT *, '2026-07-12' AS carga, '07' AS mes, '12' AS dia FROM {v2}")
def sink_gold_roundtrip(d: Data):
    path = d.folder("gold")
    view = stamp(gold.meta_vs_resultado(d.integrated, d.uf), "gold", RUN_TS)
    write_layer(view, path, "meta_vs_resultado", "gold", RUN_TS)
    return scan_loads(d.spark, path, stored_schema("meta_vs_resultado", "gold")).drop("_gold_processed_at")


@query("SELECT *, '2026-07-12' AS carga, '07' AS mes, '12' AS dia FROM {v3}")
def catalog_table_scan(d: Data):
    path, layout = d.folder("catalog"), partition_columns("evolucao_temporal", "gold")
    view = stamp(gold.evolucao_temporal(d.integrated), "gold", RUN_TS)
    write_layer(view, path, "evolucao_temporal", "gold", RUN_TS)
    name = f"gold_evolucao_temporal_{uuid.uuid4().hex[:12]}"
    table = register_table(d.spark, name, path, stored_schema("evolucao_temporal", "gold"), layout)
    stored = materialise(table.drop("_gold_processed_at"), "catalog")
    d.spark.sql(f"DROP TABLE {name}")
    return stored


A_YEAR_LATER = RUN_TS.replace(year=RUN_TS.year + 1)
LOAD_SQL = f"SELECT {FACTS}, '{{load}}' AS carga FROM {{{{fx_meta_municipio}}}}"


def facts_at(d: Data, loads_of: Sequence[tuple[DataFrame, datetime]]) -> str:
    """Several loads of the municipal targets, one after the other."""
    path = d.folder("loads")
    for rows, run_ts in loads_of:
        columns = schema_for("meta_municipio", "bronze", YEARS, lineage=False).fieldNames()
        write_layer(bronze_rows(rows.select(*columns), "meta_municipio", run_ts), path, "meta_municipio", "bronze", run_ts)
    return path


def facts_of(df: DataFrame) -> DataFrame:
    return df.select(*schema_for("meta_municipio", "bronze", YEARS, lineage=False).fieldNames(), "carga")


@query(LOAD_SQL.format(load="2026-07-12") + " WHERE ano >= 1999")
def rerun_same_day(d: Data):
    """A second run of the day with fewer years leaves nothing of the first."""
    facts = d.raw("fx_meta_municipio")
    path = facts_at(d, [(facts, RUN_TS), (facts.where("ano >= 1999"), RUN_TS)])
    return facts_of(scan_loads(d.spark, path, stored_schema("meta_municipio", "bronze", YEARS)))


@query(f"SELECT {FACTS}, '2026-07-11' AS carga, '2026-07-12' AS newest FROM {{fx_meta_municipio}}")
def rerun_empty(d: Data):
    """A run without rows is the newest load, and an earlier one of the same day is gone."""
    facts = d.raw("fx_meta_municipio")
    path = facts_at(d, [(facts, EARLIER_TS), (facts, RUN_TS), (facts.where("false"), RUN_TS)])
    schema = stored_schema("meta_municipio", "bronze", YEARS)
    both = facts_of(scan_loads(d.spark, path, schema)).unionByName(facts_of(scan_load(d.spark, path, schema)))
    return both.withColumn("newest", F.lit(loads(d.spark, path)[-1]))


@query(LOAD_SQL.format(load="2026-07-12") + " UNION ALL " + LOAD_SQL.format(load="2027-07-12") + " WHERE ano >= 1999")
def load_a_year_later(d: Data):
    """A load on the same day of the next year stands beside the first."""
    facts = d.raw("fx_meta_municipio")
    path = facts_at(d, [(facts, RUN_TS), (facts.where("ano >= 1999"), A_YEAR_LATER)])
    return facts_of(scan_loads(d.spark, path, stored_schema("meta_municipio", "bronze", YEARS)))
