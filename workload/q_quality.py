"""Rules, reports, quarantine, profiles and checks between tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.contracts import EVENT_ENTITY
from lodestrata.functions.events import EVENT_TYPES, UUID_PATTERN
from lodestrata.operators import gold, profile
from lodestrata.operators.quality import (
    MUNICIPALITY_KEY,
    Rule,
    accepted,
    in_range,
    matches,
    min_count,
    not_null,
    quality_report,
    quality_reports,
    quarantine_split,
    rules_for,
    unique,
    with_row_reasons,
)
from lodestrata.session import materialise
from workload.data import EARLIER_TS, RUN_TS, Data
from workload.fixtures import FIT
from workload.oracle import STUDENT, STUDENTS_TYPED
from workload.registry import SELECTS, query
from workload import q_gold  # noqa: F401 - its SELECTs are judged by dq_report
from workload.q_storage import store_twice

REPORT = ["check", "tipo", "critico", "aprovado", "medida"]


def _measure_sql(rule: Rule) -> str:
    c = rule.column
    if rule.kind == "not_null":
        return f"count(*) FILTER (WHERE {c} IS NULL)"
    if rule.kind == "unique":
        return f"count(*) - count(DISTINCT {c}) - CAST(coalesce(bool_or({c} IS NULL), false) AS INTEGER)"
    if rule.kind == "regex":
        return f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT regexp_full_match({c}, '{rule.pattern}'))"
    if rule.kind == "range":
        return f"count(*) FILTER (WHERE {_outside(rule)})"
    if rule.kind == "accepted_values":
        return f"count(*) FILTER (WHERE {c} NOT IN ({', '.join(repr(v) for v in rule.values)}))"
    if rule.kind == "key_length":
        return f"count(*) FILTER (WHERE length({c}) <> {rule.minimum})"
    return "count(*)"


def _outside(rule: Rule) -> str:
    bounds = [(rule.minimum, "<"), (rule.maximum, ">")]
    return "(" + " OR ".join(f"{rule.column} {sign} {bound}" for bound, sign in bounds if bound is not None) + ")"


def _from(table: str) -> str:
    """A table of the SQL by name, or the result of a query."""
    return f"({SELECTS[table]})" if table in SELECTS else f"{{{table}}}"


def _report_sql(table: str, rules: list[Rule], first: str = "") -> str:
    parts = []
    for rule in rules:
        passed = f"m >= {rule.minimum}" if rule.kind == "min_count" else "m = 0"
        parts.append(
            f"""SELECT {first} '{rule.label}' AS "check", '{rule.kind}' AS tipo, {str(rule.critical).lower()} AS critico,
  {passed} AS aprovado, m AS medida FROM (SELECT CAST({_measure_sql(rule)} AS BIGINT) AS m FROM {_from(table)})"""
        )
    return " UNION ALL ".join(parts)


NOT_NULL = [not_null(c) for c in ("id_municipio", "sigla_uf", "taxa_alfabetizacao", "meta_alfabetizacao_1996")]


@query(_report_sql("fx_meta_municipio", NOT_NULL))
def dq_not_null(d: Data):
    return quality_report(d.raw("fx_meta_municipio"), NOT_NULL).select(*REPORT)


UNIQUE = [unique("id_aluno"), unique("alfabetizado")]


@query(_report_sql("fx_alunos", UNIQUE))
def dq_unique(d: Data):
    return quality_report(d.raw("fx_alunos"), UNIQUE).select(*REPORT)


REGEX = [matches("id_municipio", MUNICIPALITY_KEY), matches("sigla_uf", r"[A-Z]+_\d+")]


@query(_report_sql("fx_meta_municipio", REGEX))
def dq_regex(d: Data):
    return quality_report(d.raw("fx_meta_municipio"), REGEX).select(*REPORT)


RANGE = [
    in_range("taxa_alfabetizacao", 0, 100),
    in_range("meta", minimum=40),
    in_range("ano", maximum=2000, critical=False),
]


@query(_report_sql("fx_eventos", RANGE))
def dq_range(d: Data):
    return quality_report(d.raw("fx_eventos"), RANGE).select(*REPORT)


MIN_COUNT = [min_count(1), min_count(10**12)]


@query(_report_sql("fx_alunos", MIN_COUNT))
def dq_min_count(d: Data):
    return quality_report(d.raw("fx_alunos"), MIN_COUNT).select(*REPORT)


BOOK = {
    ("uf", "bronze"): "fx_uf",
    ("uf", "silver"): "uf",
    ("uf", "gold"): "uf",
    ("municipio", "bronze"): "fx_municipio",
    ("municipio", "silver"): "municipio",
    ("municipio", "gold"): "municipio",
    ("meta_brasil", "bronze"): "fx_meta_brasil",
    ("meta_brasil", "silver"): "meta_brasil",
    ("meta_brasil", "gold"): "gold_meta_brasil",
    ("meta_uf", "bronze"): "fx_meta_uf",
    ("meta_uf", "silver"): "meta_uf",
    ("meta_uf", "gold"): "gold_meta_uf",
    ("meta_municipio", "bronze"): "fx_meta_municipio",
    ("meta_municipio", "silver"): "meta_municipio",
    ("meta_municipio", "gold"): "gold_meta_municipio",
    ("alunos", "bronze"): "fx_alunos",
    ("alunos", "silver"): "alunos",
    ("alunos", "gold"): "gold_alunos",
    (EVENT_ENTITY, "bronze"): "fx_eventos",
    (EVENT_ENTITY, "silver"): "events_clean",
    (EVENT_ENTITY, "gold"): "events_clean",
}


@query(
    " UNION ALL ".join(
        _report_sql(table, rules_for(*at, **FIT), f"'{at[0]}' AS entidade, '{at[1]}' AS camada,")
        for at, table in BOOK.items()
    )
)
def dq_report(d: Data):
    """The rules of the rule book. Clean tables are stored, as the jobs find them; each table is read once for all its layers."""
    d.keep("fx_meta_municipio")
    clean = {name: materialise(getattr(d, name), name) for name in ("meta_brasil", "alunos", "events_clean")}
    d.meta_municipio = materialise(d.meta_municipio, "meta_municipio")
    tables = {
        **{name: d.raw(name) for name in dict.fromkeys(BOOK.values()) if name.startswith("fx_")},
        **clean,
        "uf": d.uf,
        "municipio": d.municipio,
        "meta_uf": d.meta_uf,
        "meta_municipio": d.meta_municipio,
        "gold_meta_brasil": gold.gold_meta_brasil(clean["meta_brasil"]),
        "gold_meta_uf": gold.gold_meta_uf(d.meta_uf),
        "gold_meta_municipio": gold.gold_meta_municipio(d.integrated),
        "gold_alunos": gold.gold_alunos(clean["alunos"]),
    }
    sets: dict[str, dict] = {}
    for at, table in BOOK.items():
        sets.setdefault(table, {})[at] = rules_for(*at, **FIT)
    reports = [quality_reports(tables[table], book, ("entidade", "camada")) for table, book in sets.items()]
    return reduce(DataFrame.unionByName, reports).select("entidade", "camada", *REPORT)


ROW_RULES = [
    not_null("id_municipio"),
    in_range("proficiencia", 0, 1000),
    matches("rede", "[A-O]"),
    unique("id_aluno"),
    not_null("proficiencia", critical=False),
    min_count(1),
]
_JUDGED = f"""SELECT *, nullif(concat_ws(';', CASE WHEN id_municipio IS NULL THEN 'id_municipio' END,
  CASE WHEN proficiencia < 0 OR proficiencia > 1000 THEN 'proficiencia' END,
  CASE WHEN rede IS NULL OR NOT regexp_full_match(rede, '[A-O]') THEN 'rede' END,
  CASE WHEN row_number() OVER (PARTITION BY id_aluno ORDER BY ano NULLS LAST, id_municipio NULLS LAST,
    id_escola NULLS LAST, serie NULLS LAST, rede NULLS LAST, alfabetizado NULLS LAST, proficiencia NULLS LAST,
    peso_aluno NULLS LAST) > 1 THEN 'id_aluno' END), '') AS _motivo_quarentena FROM ({STUDENTS_TYPED})"""


@query(f"SELECT * FROM ({_JUDGED}) WHERE _motivo_quarentena IS NOT NULL")
def quarantine_rows(d: Data):
    return quarantine_split(d.students_typed, ROW_RULES)[1]


@query(f"SELECT {STUDENT} FROM ({_JUDGED}) WHERE _motivo_quarentena IS NULL")
def quarantine_valid(d: Data):
    return quarantine_split(d.students_typed, ROW_RULES)[0]


EVENT_RULES = [
    matches("event_id", UUID_PATTERN),
    accepted("event_type", EVENT_TYPES),
    matches("id_municipio", MUNICIPALITY_KEY),
    in_range("ano", 1996, 2000),
]
EVENT_REASON_SQL = f"""nullif(concat_ws(';',
  CASE WHEN NOT regexp_full_match(event_id, '{UUID_PATTERN}') THEN 'event_id' END,
  CASE WHEN event_type NOT IN ({', '.join(repr(t) for t in EVENT_TYPES)}) THEN 'event_type' END,
  CASE WHEN NOT regexp_full_match(id_municipio, '{MUNICIPALITY_KEY}') THEN 'id_municipio' END,
  CASE WHEN ano < 1996 OR ano > 2000 THEN 'ano' END), '')"""


@query(f"""SELECT event_id, event_type, "timestamp", id_municipio, ano, {EVENT_REASON_SQL} AS _motivo_quarentena
FROM {{fx_eventos}}""")
def event_contract(d: Data):
    columns = ["event_id", "event_type", "timestamp", "id_municipio", "ano"]
    return with_row_reasons(d.raw("fx_eventos").select(*columns), EVENT_RULES)


@query("""SELECT *, CAST(total = distintos AS INTEGER) AS valor FROM (
  SELECT 'bruto' AS caso, count(*) AS total, count(DISTINCT id_municipio) AS distintos FROM {fx_municipio}
  UNION ALL SELECT 'limpo', count(*), count(DISTINCT id_municipio) FROM {municipio})""")
def dq_key_unique(d: Data):
    cases = {"bruto": d.raw("fx_municipio"), "limpo": d.municipio}
    reports = [
        profile.key_is_unique(df, "id_municipio").withColumn("caso", F.lit(name)) for name, df in cases.items()
    ]
    return reports[0].unionByName(reports[1])


@query("""SELECT 'id_municipio' AS coluna, count(*) FILTER (WHERE length(id_municipio) <> 7) AS fora_do_tamanho,
  CAST(count(*) FILTER (WHERE length(id_municipio) <> 7) = 0 AS INTEGER) AS valor FROM {fx_municipio}
UNION ALL SELECT 'limpo', count(*) FILTER (WHERE length(id_municipio) <> 7),
  CAST(count(*) FILTER (WHERE length(id_municipio) <> 7) = 0 AS INTEGER) FROM {municipio}""")
def dq_key_length(d: Data):
    cases = {"id_municipio": d.raw("fx_municipio"), "limpo": d.municipio}
    reports = [
        profile.key_lengths(df, "id_municipio", 7).withColumn("coluna", F.lit(name)) for name, df in cases.items()
    ]
    return reports[0].unionByName(reports[1])


@query("""SELECT *, CAST(orfaos = 0 AS INTEGER) AS valor FROM (
  SELECT count(*) FILTER (WHERE nome_municipio IS NULL) AS orfaos FROM {batch})""")
def dq_no_orphans(d: Data):
    return profile.no_orphans(d.batch)


@query("""SELECT *, CAST(inconsistentes = 0 AS INTEGER) AS valor FROM (SELECT count(*) FILTER (
  WHERE abs(gap_meta - (pct_alfabetizados - meta_pct)) > 0.01) AS inconsistentes FROM {v1})""")
def dq_gap_consistency(d: Data):
    return profile.gap_is_consistent(gold.indicador_municipio(d.integrated))


@query("""SELECT *, CAST(n > 0 AS INTEGER) AS valor FROM (
  SELECT count(*) FILTER (WHERE _source_type = 'streaming') AS n FROM {integrated})""")
def dq_stream_present(d: Data):
    return profile.stream_present(d.integrated)


BANDS = {"alunos": (1, 10**12), "meta_brasil": (1, 10), "meta_municipio": (1000, 10**12)}


@query(" UNION ALL ".join(
    f"""SELECT '{name}' AS tabela, count(*) AS total, {low}::BIGINT AS minimo, {high}::BIGINT AS maximo,
  count(*) BETWEEN {low} AND {high} AS aprovado FROM {{{name}}}""" for name, (low, high) in BANDS.items()))
def volume_check(d: Data):
    tables = {"alunos": d.alunos, "meta_brasil": d.meta_brasil, "meta_municipio": d.meta_municipio}
    return profile.volume_check(tables, BANDS)


COMPLETE = ["taxa_alfabetizacao", "sigla_uf", "ano"]


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS coluna, CAST(round(CAST(s AS DECIMAL(18,8)), 6) AS DOUBLE) AS completude, s >= 0.9 AS aprovado
FROM (SELECT avg(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END) AS s FROM {{fx_meta_municipio}})""" for c in COMPLETE))
def completeness_ratio(d: Data):
    return profile.completeness(d.raw("fx_meta_municipio"), COMPLETE, 0.9)


ROLES = {
    "ano": ("INTEGER", "chave"),
    "id_municipio": ("STRING", "chave"),
    "id_escola": ("STRING", "chave"),
    "id_aluno": ("STRING", "chave"),
    "caderno": ("STRING", "dimensao"),
    "serie": ("STRING", "dimensao"),
    "rede": ("STRING", "dimensao"),
    "presenca": ("STRING", "dimensao"),
    "preenchimento_caderno": ("STRING", "dimensao"),
    "alfabetizado": ("STRING", "resultado"),
    "proficiencia": ("STRING", "resultado"),
    "peso_aluno": ("FLOAT", "resultado"),
}


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS nome, '{kind}' AS tipo, '{role}' AS papel, count(*) FILTER (WHERE {c} IS NULL) AS nulos,
  count(*) AS total_linhas FROM {{fx_alunos}}""" for c, (kind, role) in ROLES.items()))
def profile_table(d: Data):
    return profile.profile_table(d.raw("fx_alunos"))


@query("SELECT DISTINCT ano FROM {fx_alunos}")
def profile_years(d: Data):
    return profile.profile_years(d.raw("fx_alunos"))


@query("""SELECT 'id_municipio,ano,rede,serie,id_aluno' AS chaves, count(*) - (SELECT count(*) FROM (
  SELECT DISTINCT id_municipio, ano, rede, serie, id_aluno FROM {fx_alunos})) AS duplicatas FROM {fx_alunos}""")
def profile_dup_keys(d: Data):
    return profile.profile_duplicate_keys(d.raw("fx_alunos"))


@query("""SELECT id_municipio, sigla_uf, ano, rede, taxa_alfabetizacao FROM {meta_municipio}
ORDER BY id_municipio NULLS LAST, sigla_uf NULLS LAST, ano NULLS LAST, rede NULLS LAST,
  taxa_alfabetizacao NULLS LAST LIMIT 5""")
def profile_sample(d: Data):
    return profile.profile_sample(
        d.meta_municipio.select("id_municipio", "sigla_uf", "ano", "rede", "taxa_alfabetizacao")
    )


@query("""SELECT 'cargas' AS caso, count(*) AS origem, 2 * count(*) AS destino, true AS multiplo, true AS aprovado
FROM {fx_meta_municipio}
UNION ALL SELECT 'gold', n, g, g % n = 0, g % n = 0 AND g >= n FROM (SELECT (SELECT count(*) FROM {integrated}) AS n,
  (SELECT count(*) FROM {v3}) AS g)""")
def reconcile_counts(d: Data):
    """Two loads of one table hold it twice; a view of the batch rows is smaller than the integrated table."""
    staged = d.raw("fx_meta_municipio")
    stored = store_twice(d, staged, "meta_municipio", (EARLIER_TS, RUN_TS))
    reports = {
        "cargas": profile.reconcile_counts(staged, stored),
        "gold": profile.reconcile_counts(d.integrated, gold.evolucao_temporal(d.integrated)),
    }
    tagged = [report.withColumn("caso", F.lit(name)) for name, report in reports.items()]
    return tagged[0].unionByName(tagged[1])


_CODES = "SELECT DISTINCT upper(trim({})) AS c FROM {{{}}}"
_SETS = """SELECT '{0}' AS caso, so_esquerda, so_direita, so_esquerda = 0 AND so_direita = 0 AS iguais FROM (SELECT
  (SELECT count(*) FROM (({1}) EXCEPT ({2}))) AS so_esquerda,
  (SELECT count(*) FROM (({2}) EXCEPT ({1}))) AS so_direita)"""


@query(
    _SETS.format("uf", _CODES.format("sigla", "fx_uf"), _CODES.format("sigla_uf", "uf"))
    + " UNION ALL "
    + _SETS.format("meta", _CODES.format("sigla", "fx_uf"), _CODES.format("sigla_uf", "fx_meta_municipio"))
)
def reconcile_value_sets(d: Data):
    raw = d.raw("fx_uf").select(F.upper(F.trim("sigla")).alias("c"))
    clean = d.uf.select(F.col("sigla_uf").alias("c"))
    facts = d.raw("fx_meta_municipio").select(F.upper(F.trim("sigla_uf")).alias("c"))
    cases = {"uf": clean, "meta": facts}
    tagged = [
        profile.reconcile_value_sets(raw, other, "c").withColumn("caso", F.lit(name))
        for name, other in cases.items()
    ]
    return tagged[0].unionByName(tagged[1])
