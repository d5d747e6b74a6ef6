"""Projections, scalar functions, lineage, schema contracts, wire format."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.contracts import conform, schema_for
from lodestrata.functions import events, lineage, numbers, targets, text
from lodestrata.operators import entities
from lodestrata.sources.tables import extract
from workload.data import RUN_TS, Data
from workload.fixtures import TARGETS, YEARS
from workload.oracle import IN_FORCE, LAST, OWN_TARGET, hit, pad, r2
from workload.registry import query

T = ", ".join(TARGETS)
KEY = ["ano", "id_municipio", "rede"]


@query(f"SELECT id_municipio, nome, {pad('id_municipio')} AS chave FROM {{fx_municipio}}")
def pad_key(d: Data):
    return d.raw("fx_municipio").select("id_municipio", "nome", text.pad_key(F.col("id_municipio")).alias("chave"))


@query(
    "SELECT id_municipio, nome, nullif(upper(substr(nome, 1, 2)), '') AS codigo,"
    " nullif(upper(substr('', 1, 2)), '') AS vazio FROM {fx_municipio}"
)
def short_code(d: Data):
    return d.raw("fx_municipio").select(
        "id_municipio",
        "nome",
        text.short_code(F.col("nome")).alias("codigo"),
        text.short_code(F.lit("")).alias("vazio"),
    )


@query("""SELECT id_aluno, ano, caderno, proficiencia AS texto, TRY_CAST(proficiencia AS DOUBLE) AS proficiencia
FROM {fx_alunos}""")
def lenient_numeric(d: Data):
    return d.raw("fx_alunos").select(
        "id_aluno",
        "ano",
        "caderno",
        F.col("proficiencia").alias("texto"),
        numbers.lenient_double(F.col("proficiencia")).alias("proficiencia"),
    )


@query("""SELECT id_aluno, ano, caderno, alfabetizado AS dado, coalesce(alfabetizado,
  CASE WHEN TRY_CAST(proficiencia AS DOUBLE) >= 743 THEN '1' ELSE '0' END) AS alfabetizado FROM {fx_alunos}""")
def derive_flag(d: Data):
    score = numbers.lenient_double(F.col("proficiencia"))
    return d.raw("fx_alunos").select(
        "id_aluno",
        "ano",
        "caderno",
        F.col("alfabetizado").alias("dado"),
        targets.derived_flag(F.col("alfabetizado"), score).alias("alfabetizado"),
    )


@query(f"""SELECT event_id, "timestamp", taxa_alfabetizacao AS lida,
  CASE WHEN taxa_alfabetizacao IS NOT NULL THEN {r2('greatest(0, least(100, taxa_alfabetizacao))')} END AS taxa
FROM {{fx_eventos}}""")
def clamp_percent(d: Data):
    return d.raw("fx_eventos").select(
        "event_id",
        "timestamp",
        F.col("taxa_alfabetizacao").alias("lida"),
        numbers.clamp_percent(F.col("taxa_alfabetizacao")).alias("taxa"),
    )


@query(f"SELECT ano, id_municipio, rede, {IN_FORCE} AS meta_vigente FROM {{fx_meta_municipio}}")
def target_in_force(d: Data):
    df = d.raw("fx_meta_municipio")
    return df.select(*KEY, targets.target_in_force(df.columns).alias("meta_vigente"))


@query(f"SELECT ano, id_municipio, rede, coalesce({T}) AS meta_vigente FROM {{fx_meta_municipio}}")
def target_first_non_null(d: Data):
    df = d.raw("fx_meta_municipio")
    return df.select(*KEY, targets.target_first_non_null(df.columns).alias("meta_vigente"))


@query(f"""SELECT ano, id_municipio, rede, coalesce({OWN_TARGET}, {TARGETS[0]}, {LAST}, taxa_alfabetizacao) AS meta,
  coalesce({OWN_TARGET}, {TARGETS[0]}, {LAST}, 0.0::DOUBLE) AS meta_sem_taxa FROM {{fx_meta_municipio}}""")
def target_event_fallback(d: Data):
    df = d.raw("fx_meta_municipio")
    without_rate = [c for c in df.columns if c != "taxa_alfabetizacao"]
    return df.select(
        *KEY,
        targets.target_event_fallback(df.columns).alias("meta"),
        targets.target_event_fallback(without_rate).alias("meta_sem_taxa"),
    )


@query(f"""SELECT ano, id_municipio, rede, taxa_alfabetizacao - {IN_FORCE} AS gap_simples,
  {r2(f'taxa_alfabetizacao - {IN_FORCE}')} AS gap_meta, {hit('taxa_alfabetizacao', IN_FORCE)} AS atingiu_meta
FROM {{fx_meta_municipio}}""")
def gap_and_hit(d: Data):
    df = targets.with_target_gap(d.raw("fx_meta_municipio"))
    plain = targets.gap(F.col("taxa_alfabetizacao"), F.col("meta_vigente"))
    return df.select(*KEY, plain.alias("gap_simples"), "gap_meta", "atingiu_meta")


@query("""SELECT id_uf, sigla, nome, regiao, md5(concat_ws('|', coalesce(id_uf, ''), coalesce(sigla, ''),
  coalesce(nome, ''), coalesce(regiao, ''))) AS _record_hash FROM {fx_uf}""")
def row_fingerprint(d: Data):
    df = d.raw("fx_uf")
    return df.withColumn("_record_hash", lineage.fingerprint(df.columns))


@query("""SELECT ano AS ano_avaliacao, id_municipio, rede, strftime(_ingestion_timestamp, '%Y') AS ano,
  strftime(_ingestion_timestamp, '%m') AS mes, strftime(_ingestion_timestamp, '%d') AS dia FROM {fx_snapshots}""")
def ingest_date_parts(d: Data):
    df = d.raw("fx_snapshots").select(
        F.col("ano").alias("ano_avaliacao"), "id_municipio", "rede", "_ingestion_timestamp"
    )
    return df.withColumns(lineage.date_parts(F.col("_ingestion_timestamp"))).drop("_ingestion_timestamp")


@query("""SELECT id_uf, sigla, nome, regiao, '2026-07-12 10:30:00' AS carga, '2026-07-12' AS _ingestion_date,
  'uf' AS _source_entity, 'etl-bronze-batch' AS _job_name, md5(concat_ws('|', id_uf, sigla, nome, regiao))
  AS _record_hash, '2026' AS ano, '07' AS mes, '12' AS dia FROM {fx_uf}""")
def bronze_lineage(d: Data):
    rows = lineage.bronze_rows(d.raw("fx_uf"), "uf", RUN_TS)
    loaded = F.date_format("_ingestion_timestamp", "yyyy-MM-dd HH:mm:ss")
    return rows.withColumn("carga", loaded).drop("_ingestion_timestamp")


@query("""SELECT event_id, event_type, "timestamp", id_municipio, ano, '2026-07-12' AS _ingestion_date,
  'indicador_alfabetizacao' AS _source_entity, 'etl-bronze-streaming' AS _job_name, 'streaming' AS _source_type,
  md5(concat_ws('|', event_id, event_type, "timestamp", id_municipio, CAST(ano AS VARCHAR))) AS _record_hash,
  '07' AS mes, '12' AS dia FROM {fx_eventos}""")
def bronze_events(d: Data):
    columns = ["event_id", "event_type", "timestamp", "id_municipio", "ano"]
    return lineage.bronze_events(d.raw("fx_eventos").select(*columns), RUN_TS).drop("_ingestion_timestamp")


@query("""SELECT id_municipio AS key, event_id, event_type, "timestamp", id_municipio, sigla_uf, ano,
  CAST(round(CAST(taxa_alfabetizacao AS DECIMAL(18,6)), 4) AS DOUBLE) AS taxa_alfabetizacao,
  CAST(round(CAST(meta AS DECIMAL(18,6)), 4) AS DOUBLE) AS meta FROM {fx_eventos}""")
def encode_events_json(d: Data):
    wire = events.encode_events(d.raw("fx_eventos"))
    path = {
        "event_id": "$.event_id",
        "event_type": "$.event_type",
        "timestamp": "$.timestamp",
        "id_municipio": "$.payload.id_municipio",
        "sigla_uf": "$.payload.sigla_uf",
        "ano": "$.payload.ano",
        "taxa_alfabetizacao": "$.payload.taxa_alfabetizacao",
        "meta": "$.payload.meta",
    }
    fields = {name: F.get_json_object("value", at) for name, at in path.items()}
    # Numbers are compared as decimals: engines write a double's digits in different ways.
    numbers = {n: F.round(fields[n].cast("double").cast("decimal(18,6)"), 4).cast("double") for n in ("taxa_alfabetizacao", "meta")}
    return wire.withColumns({**fields, **numbers, "ano": fields["ano"].cast("int")}).drop("value")


@query("""SELECT event_id, event_type, "timestamp", id_municipio, sigla_uf, ano, taxa_alfabetizacao, meta
FROM {fx_eventos}""")
def parse_event_json(d: Data):
    return events.decode_events(events.encode_events(d.raw("fx_eventos")))


@query(f"""SELECT ano, id_municipio, rede, taxa_alfabetizacao, {T}, nivel_alfabetizacao, percentual_participacao
FROM {{fx_snapshots}}""")
def conform_schema(d: Data):
    as_text = d.raw("fx_snapshots").withColumn("ano", F.col("ano").cast("string"))
    return conform(as_text, schema_for("meta_municipio", "bronze", YEARS, lineage=False))


@query("SELECT ano, id_municipio, rede, taxa_alfabetizacao FROM {fx_snapshots}")
def project_present(d: Data):
    return entities.project_present(d.raw("fx_snapshots"), [*KEY, "serie", "taxa_alfabetizacao", "proficiencia"])


@query(f"""SELECT ano, id_municipio, sigla_uf, rede, taxa_alfabetizacao, {T}, nivel_alfabetizacao,
  percentual_participacao FROM {{fx_snapshots}}""")
def drop_technical(d: Data):
    return lineage.drop_technical(d.raw("fx_snapshots"))


@query("""SELECT ano, id_municipio, id_escola, id_aluno, rede, proficiencia, peso_aluno FROM {fx_alunos}
WHERE ano IN (1996, 1997)""")
def extract_projection(d: Data):
    columns = ["ano", "id_municipio", "id_escola", "id_aluno", "rede", "proficiencia", "peso_aluno"]
    return extract(d.raw("fx_alunos"), columns, years=[1996, 1997])
