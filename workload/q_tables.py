"""Cleaning, joins, deduplication, merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.functions.text import pad_key
from lodestrata.operators import dedup, entities, gold, integrate
from workload.data import Data
from workload.oracle import STUDENT, pad
from workload.registry import query

FACT = ["ano", "id_municipio", "rede"]


@query("SELECT * FROM {uf}")
def clean_uf(d: Data):
    return d.uf


@query("SELECT * FROM {municipio}")
def clean_municipio(d: Data):
    return d.municipio


@query("SELECT * FROM {meta_brasil}")
def clean_meta_brasil(d: Data):
    return d.meta_brasil


@query("SELECT * FROM {meta_uf}")
def clean_meta_uf(d: Data):
    return d.meta_uf


@query("SELECT * FROM {meta_municipio}")
def clean_meta_municipio(d: Data):
    return d.meta_municipio


@query(f"SELECT {STUDENT} FROM {{alunos}}")
def clean_alunos(d: Data):
    return d.alunos


@query(f"""SELECT f.ano, f.id_municipio, f.rede, coalesce(f.sigla_uf, m.sigla_uf) AS sigla_uf
FROM (SELECT ano, {pad('id_municipio')} AS id_municipio, rede, sigla_uf FROM {{fx_meta_municipio}}) f
LEFT JOIN {{municipio}} m USING (id_municipio)""")
def enrich_from_lookup(d: Data):
    facts = d.raw("fx_meta_municipio").select(
        "ano", pad_key(F.col("id_municipio")).alias("id_municipio"), "rede", "sigla_uf"
    )
    return entities.enrich_from_lookup(facts, d.municipio, "id_municipio", "sigla_uf")


@query("SELECT DISTINCT id_uf, regiao FROM {fx_uf}")
def distinct_lookup(d: Data):
    return dedup.distinct_lookup(d.raw("fx_uf"), ["id_uf", "regiao"])


@query("SELECT * FROM {batch}")
def integrate_batch(d: Data):
    return d.batch


EVENT_COLUMNS = ["event_id", "id_municipio", "ano", "rede", "nome_municipio", "nome_uf", "sigla_uf", "indicador_uf"]


@query(f"SELECT {', '.join(EVENT_COLUMNS)}, taxa_alfabetizacao, _source_type FROM {{events_rich}}")
def enrich_events(d: Data):
    clean = entities.clean_events(d.raw("fx_eventos"))
    rich = integrate.enrich_events(clean, d.municipio, d.meta_uf)
    return rich.select(*EVENT_COLUMNS, "taxa_alfabetizacao", "_source_type")


@query("""SELECT ano, id_municipio, rede, taxa_alfabetizacao FROM {meta_municipio} f
WHERE NOT EXISTS (SELECT 1 FROM {municipio} m WHERE m.id_municipio = f.id_municipio)""")
def orphans_anti_join(d: Data):
    return integrate.orphans(d.meta_municipio, d.municipio).select(*FACT, "taxa_alfabetizacao")


@query("""SELECT ano, id_municipio, rede, taxa_alfabetizacao FROM {meta_municipio} f
WHERE EXISTS (SELECT 1 FROM {municipio} m WHERE m.id_municipio = f.id_municipio)""")
def valid_semi_join(d: Data):
    return integrate.matched(d.meta_municipio, d.municipio).select(*FACT, "taxa_alfabetizacao")


@query("""SELECT ano, id_municipio, rede, nome_municipio IS NULL AS orfao FROM {batch}""")
def split_orphans(d: Data):
    present, missing = integrate.split_orphans(d.batch.select(*FACT, "nome_municipio"))
    tagged = present.withColumn("orfao", F.lit(False)).unionByName(missing.withColumn("orfao", F.lit(True)))
    return tagged.drop("nome_municipio")


@query("""SELECT ano, id_municipio, rede, sigla_uf, sigla_uf_municipio, reason AS _motivo_quarentena FROM {judged}
WHERE reason IS NOT NULL""")
def referential_check(d: Data):
    set_aside = integrate.referential_split(d.batch)[1]
    return set_aside.select(*FACT, "sigla_uf", "sigla_uf_municipio", "_motivo_quarentena")


@query("""SELECT id_municipio, ano, rede, _source_type, taxa_alfabetizacao, nome_municipio, NULL::VARCHAR AS event_id
FROM {valid} UNION ALL SELECT id_municipio, ano, 'total', 'streaming', taxa_alfabetizacao, NULL, event_id
FROM {events_clean}""")
def union_batch_stream(d: Data):
    tagged = entities.clean_events(d.raw("fx_eventos")).withColumns(
        {"rede": F.lit(integrate.EVENT_NETWORK), "_source_type": F.lit("streaming")}
    )
    both = integrate.union_sources(d.valid, tagged)
    return both.select(
        "id_municipio", "ano", "rede", "_source_type", "taxa_alfabetizacao", "nome_municipio", "event_id"
    )


@query("SELECT * FROM {events_clean}")
def latest_event(d: Data):
    return entities.clean_events(d.raw("fx_eventos"))


MERGED = [
    "id_municipio", "ano", "rede", "taxa_alfabetizacao", "sigla_uf", "nome_municipio", "indicador_uf", "event_id",
    "_source_type",
]


@query(f"""SELECT 'total' AS caso, {', '.join(MERGED)} FROM {{merged}}
UNION ALL SELECT 'F', {', '.join(MERGED)} FROM {{merged_f}}""")
def merge_precedence(d: Data):
    """Events under a network of their own, and under one that batch rows have too."""
    cases = [d.merged(network).select(F.lit(network).alias("caso"), *MERGED) for network in ("total", "F")]
    return cases[0].unionByName(cases[1])


@query("""SELECT 'batch' AS caso, id_municipio, ano, rede, _source_type FROM {base}
UNION ALL SELECT 'eventos', id_municipio, ano, rede, _source_type FROM {integrated}
WHERE _source_type = 'streaming'""")
def base_or_fallback(d: Data):
    columns = ["id_municipio", "ano", "rede", "_source_type"]
    slim = d.integrated.select(*columns)
    only_events = slim.where(F.col("_source_type") == "streaming")
    return (
        gold.base_rows(slim)
        .select(F.lit("batch").alias("caso"), *columns)
        .unionByName(gold.base_rows(only_events).select(F.lit("eventos").alias("caso"), *columns))
    )


@query("""SELECT ano, id_municipio, rede, taxa_alfabetizacao, strftime(_ingestion_timestamp, '%Y-%m-%d') AS carga
FROM {fx_snapshots} QUALIFY row_number() OVER (PARTITION BY ano, id_municipio, rede
  ORDER BY _ingestion_timestamp DESC) = 1""")
def latest_snapshot(d: Data):
    newest = dedup.latest_snapshot(d.raw("fx_snapshots"), FACT)
    return newest.select(
        *FACT, "taxa_alfabetizacao", F.date_format("_ingestion_timestamp", "yyyy-MM-dd").alias("carga")
    )
