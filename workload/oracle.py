"""Building blocks of the checking SQL: one named SELECT per derived table, put together as CTEs."""

from __future__ import annotations

import re

from workload.fixtures import SOURCES, TARGETS, YEARS, needs, source_sql

LAST = TARGETS[-1]


def pad(x: str) -> str:
    return f"CASE WHEN length({x}) < 7 THEN lpad({x}, 7, '0') ELSE {x} END"


def title(x: str) -> str:
    words = f"string_split(trim({x}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def r2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(18,6)), 2) AS DOUBLE)"


def mean2(x: str) -> str:
    return r2(f"CAST(sum(CAST({x} AS DECIMAL(18,6))) AS DOUBLE) / nullif(count({x}), 0)")


def first_by(keys: str, order: str) -> str:
    """``order`` lists columns; each is ascending with nulls last unless it says otherwise."""
    parts = [o.strip() for o in order.split(",")]
    terms = ", ".join(o if "NULLS" in o else f"{o} ASC NULLS LAST" for o in parts)
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {terms}) = 1"


OWN_TARGET = "CASE ano " + " ".join(f"WHEN {y} THEN meta_alfabetizacao_{y}" for y in YEARS) + " END"
IN_FORCE = f"coalesce({OWN_TARGET}, {LAST})"
T = ", ".join(TARGETS)
STUDENT = "ano, id_municipio, id_escola, id_aluno, serie, rede, alfabetizado, proficiencia, peso_aluno"
INTEGRATED = (
    f"ano, id_municipio, sigla_uf, rede, taxa_alfabetizacao, {T}, nivel_alfabetizacao, percentual_participacao,"
    " gap_meta, atingiu_meta, nome_municipio, nome_uf, indicador_uf, event_id, _source_type"
)


def hit(rate: str, target: str) -> str:
    return f"CASE WHEN {rate} IS NOT NULL AND {target} IS NOT NULL THEN {rate} >= {target} END"


def with_gap(source: str) -> str:
    return f"""SELECT *, {r2('taxa_alfabetizacao - meta_vigente')} AS gap2,
  {hit('taxa_alfabetizacao', 'meta_vigente')} AS hit
FROM (SELECT *, {IN_FORCE} AS meta_vigente FROM {source})"""


def enriched(network: str) -> str:
    return f"""SELECT v.* EXCLUDE (sigla_uf), code AS sigla_uf, indicador_uf,
  '{network}' AS rede, 'streaming' AS _source_type
FROM (SELECT e.*, nome_municipio, nome_uf, m.sigla_uf AS sigla_uf_municipio, coalesce(e.sigla_uf, m.sigla_uf) AS code
      FROM {{events_clean}} e LEFT JOIN {{municipio}} m USING (id_municipio)) v
LEFT JOIN {{state_rate}} s ON s.sigla_uf = v.code AND s.ano = v.ano"""


def merged(events: str) -> str:
    return f"""SELECT * FROM (SELECT * EXCLUDE (reason) FROM {{valid}} UNION ALL BY NAME SELECT * FROM {{{events}}})
{first_by("id_municipio, ano, rede",
          "CASE WHEN _source_type = 'streaming' THEN 0 ELSE 1 END, timestamp DESC NULLS LAST, event_id")}"""


STUDENTS_TYPED = f"""SELECT ano, {pad('id_municipio')} AS id_municipio, id_escola, trim(id_aluno) AS id_aluno,
  serie, rede, coalesce(alfabetizado, CASE WHEN TRY_CAST(proficiencia AS DOUBLE) >= 743 THEN '1' ELSE '0' END)
    AS alfabetizado, TRY_CAST(proficiencia AS DOUBLE) AS proficiencia, peso_aluno
FROM {{fx_alunos}}"""

TABLES = {
    "uf": f"""SELECT * FROM (SELECT id_uf, upper(trim(sigla)) AS sigla_uf, {title('nome')} AS nome_uf,
  trim(regiao) AS regiao FROM {{fx_uf}}) {first_by("sigla_uf", "id_uf, nome_uf, regiao")}""",
    "municipio": f"""SELECT * FROM (SELECT {pad('id_municipio')} AS id_municipio, upper(trim(sigla_uf)) AS sigla_uf,
  {title('nome')} AS nome_municipio, trim(nome_uf) AS nome_uf FROM {{fx_municipio}})
  {first_by("id_municipio", "sigla_uf, nome_municipio, nome_uf")}""",
    "meta_brasil": f"""SELECT * FROM {{fx_meta_brasil}}
  {first_by("ano, rede", f"taxa_alfabetizacao, {T}, percentual_participacao")}""",
    "meta_uf": f"""SELECT * FROM (SELECT * REPLACE (upper(trim(sigla_uf)) AS sigla_uf) FROM {{fx_meta_uf}})
  {first_by("sigla_uf, ano, rede", f"taxa_alfabetizacao, {T}, percentual_participacao")}""",
    "meta_municipio_one": f"""SELECT * EXCLUDE (_ingestion_timestamp) FROM (SELECT * REPLACE (
    {pad('id_municipio')} AS id_municipio, upper(trim(sigla_uf)) AS sigla_uf) FROM {{fx_snapshots}})
  {first_by("id_municipio, ano, rede", f"_ingestion_timestamp DESC NULLS LAST, sigla_uf, taxa_alfabetizacao, {T}")}""",
    "meta_municipio": f"""SELECT *, taxa_alfabetizacao - {IN_FORCE} AS gap_meta,
    {hit('taxa_alfabetizacao', IN_FORCE)} AS atingiu_meta
  FROM (SELECT f.* REPLACE (coalesce(f.sigla_uf, m.sigla_uf) AS sigla_uf)
        FROM {{meta_municipio_one}} f LEFT JOIN {{municipio}} m USING (id_municipio))""",
    "alunos": f"""SELECT * FROM ({STUDENTS_TYPED}) {first_by(
        "id_aluno, ano", "id_municipio, id_escola, serie, rede, alfabetizado, proficiencia, peso_aluno")}""",
    "events_clean": f"""SELECT * FROM {{fx_eventos}}
  {first_by("event_id", 'CAST("timestamp" AS TIMESTAMPTZ) DESC NULLS LAST, "timestamp", event_type, id_municipio')}""",
    "state_rate": f"""SELECT sigla_uf, ano, taxa_alfabetizacao AS indicador_uf FROM {{meta_uf}}
  {first_by("sigla_uf, ano", "rede, taxa_alfabetizacao")}""",
    "batch": """SELECT f.*, nome_municipio, nome_uf, m.sigla_uf AS sigla_uf_municipio, indicador_uf,
    'batch' AS _source_type
  FROM {meta_municipio} f LEFT JOIN {municipio} m USING (id_municipio)
  LEFT JOIN {state_rate} s ON s.sigla_uf = f.sigla_uf AND s.ano = f.ano""",
    "judged": """SELECT *, CASE WHEN nome_municipio IS NULL THEN 'municipio_inexistente'
    WHEN sigla_uf_municipio IS NOT NULL AND sigla_uf <> sigla_uf_municipio THEN 'uf_inconsistente' END AS reason
  FROM {batch}""",
    "valid": "SELECT * FROM {judged} WHERE reason IS NULL",
    "events_rich": enriched("total"),
    "events_rich_f": enriched("F"),
    "merged": merged("events_rich"),
    "merged_f": merged("events_rich_f"),
    "integrated": f"SELECT {INTEGRATED} FROM {{merged}}",
    "base": "SELECT * FROM {integrated} WHERE _source_type = 'batch'",
    "base_gap": with_gap("{base}"),
    "student_totals": """SELECT id_municipio, ano, count(id_aluno) AS total_alunos_avaliados FROM {alunos}
  GROUP BY id_municipio, ano""",
    "v1": """SELECT id_municipio, nome_municipio AS nome, sigla_uf, nome_uf, ano, rede,
    taxa_alfabetizacao AS pct_alfabetizados, meta_vigente AS meta_pct, gap2 AS gap_meta, hit AS atingiu_meta,
    indicador_uf, nivel_alfabetizacao, percentual_participacao, total_alunos_avaliados
  FROM {base_gap} LEFT JOIN {student_totals} USING (id_municipio, ano)""",
    "rollup": f"""SELECT sigla_uf, ano, {mean2('taxa_alfabetizacao')} AS taxa_media,
    {mean2('meta_vigente')} AS meta_media, {mean2('gap2')} AS gap_medio,
    count(DISTINCT id_municipio) AS municipios_total,
    count(*) FILTER (WHERE hit) AS municipios_acima_meta, count(*) FILTER (WHERE NOT hit) AS municipios_abaixo_meta
  FROM {{base_gap}} GROUP BY sigla_uf, ano""",
    "v2": f"""SELECT r.*, regiao, nome_uf, {r2('taxa_media - taxa_anterior')} AS delta_percentual FROM (
    SELECT *, lag(taxa_media) OVER (PARTITION BY sigla_uf ORDER BY ano NULLS LAST) AS taxa_anterior,
      CASE WHEN taxa_media IS NOT NULL THEN CAST(dense_rank() OVER (
        PARTITION BY ano ORDER BY taxa_media DESC NULLS LAST) AS INTEGER) END AS ranking_taxa
    FROM {{rollup}}) r LEFT JOIN {{uf}} USING (sigla_uf)""",
    "v3": f"""SELECT *, {r2('pct_alfabetizados - pct_anterior')} AS delta_percentual,
    {r2('pct_alfabetizados - pct_anterior')} AS delta_anual FROM (
    SELECT id_municipio, nome_municipio AS nome, sigla_uf, nome_uf, rede, ano,
      taxa_alfabetizacao AS pct_alfabetizados,
      lag(taxa_alfabetizacao) OVER (PARTITION BY id_municipio, rede ORDER BY ano NULLS LAST) AS pct_anterior,
      meta_vigente AS meta_pct, gap2 AS gap_meta, hit AS atingiu_meta
    FROM {{base_gap}})""",
}

# The same steps as the jobs see them: one raw load that meets the raw rules, without state codes in the facts.
for _name in ("uf", "municipio", "meta_brasil", "alunos"):
    TABLES["job_" + _name] = TABLES[_name].replace("{fx_", "{ok_")
TABLES["job_meta"] = f"""SELECT f.*, taxa_alfabetizacao - {IN_FORCE} AS gap_meta, {hit('taxa_alfabetizacao', IN_FORCE)} AS atingiu_meta
  FROM (SELECT r.*, m.sigla_uf FROM {{ok_meta_municipio}} r LEFT JOIN {{job_municipio}} m USING (id_municipio)) f"""
_STEPS = ("batch", "judged", "valid", "events_rich", "merged", "integrated", "base", "base_gap", "student_totals", "v1", "rollup", "v2", "v3")
for _name in _STEPS:
    _text = TABLES[_name].replace("{meta_municipio}", "{job_meta}")
    for _dep in ("uf", "municipio", "alunos", *_STEPS):
        _text = _text.replace("{" + _dep + "}", "{job_" + _dep + "}")
    TABLES["job_" + _name] = _text

# The integration job starts from raw rows with faults: the clean layer sets them aside, the rest is integrated.
TABLES["raw_municipio"] = "SELECT * FROM {municipio} WHERE regexp_full_match(id_municipio, '[0-9]{7}')"
TABLES["raw_meta_all"] = f"""SELECT f.*, taxa_alfabetizacao - {IN_FORCE} AS gap_meta, {hit('taxa_alfabetizacao', IN_FORCE)} AS atingiu_meta
  FROM (SELECT r.* REPLACE ({pad('r.id_municipio')} AS id_municipio, m.sigla_uf AS sigla_uf)
        FROM {{fx_meta_municipio}} r LEFT JOIN {{raw_municipio}} m ON m.id_municipio = {pad('r.id_municipio')}) f"""
TABLES["raw_meta"] = "SELECT * FROM {raw_meta_all} WHERE NOT coalesce(taxa_alfabetizacao > 100, false)"
_STEPS = ("batch", "judged", "valid", "events_rich", "merged", "integrated")
for _name in _STEPS:
    _text = TABLES[_name].replace("{meta_municipio}", "{raw_meta}")
    for _dep in ("municipio", *_STEPS):
        _text = _text.replace("{" + _dep + "}", "{raw_" + _dep + "}")
    TABLES["raw_" + _name] = _text


def oracle(select: str) -> str:
    """``select`` with every ``{name}`` it needs, directly or not, as a CTE in front."""
    order: list[str] = []

    def visit(name: str) -> None:
        text = SOURCES.get(name) or TABLES.get(name)
        if text is None or name in order:
            return
        for dep in needs(text):
            visit(dep)
        order.append(name)

    def plain(text: str) -> str:
        return re.sub(r"\{([a-z]\w*)\}", lambda m: f"o_{m[1]}" if m[1] in TABLES else m[1], text)

    for name in needs(select):
        visit(name)
    bodies = [f"{n} AS ({source_sql(n)})" if n in SOURCES else f"o_{n} AS ({plain(TABLES[n])})" for n in order]
    return (f"WITH {', '.join(bodies)} " if bodies else "") + plain(select)
