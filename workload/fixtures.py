"""Raw entities of the data model, derived from the given tables (see FIXTURES.md).

The same SELECT text runs in both engines. Every derivation reads its tables whole. The ``%``
expressions only put faults into rows (unknown keys, nulls, text for numbers); none leaves rows out.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from lodestrata.contracts import TARGET_PREFIX

YEARS = tuple(range(1996, 2002))
STATE_CODE = r"^NATION_(\d+|X)$"
FIT = {"state_code": STATE_CODE, "first_year": 1995, "last_year": 2001}
TARGETS = [f"{TARGET_PREFIX}{year}" for year in YEARS]

# Schemas of the given tables, declared so that reading them needs no look into the files
BASE_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
        " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
        " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
        " l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def _targets(key: str) -> str:
    return ", ".join(
        f"CASE WHEN ({key} + {y}) % 5 = 0 THEN NULL ELSE CAST(30 + ({key} * 7 + {y} * 3) % 50 AS DOUBLE) END"
        f" AS {TARGET_PREFIX}{y}"
        for y in YEARS
    )


_URGENT = (
    "CAST(round(CAST(100.0 * CAST(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END)"
    " AS DOUBLE) / CAST(count(*) AS DOUBLE) AS DECIMAL(18,6)), 2) AS DOUBLE)"
)
_EVENT = """
  CASE event_type WHEN 'click' THEN 'indicador_atualizado' WHEN 'view' THEN 'indicador_atualizado'
    WHEN 'purchase' THEN 'meta_revisada' WHEN 'error' THEN 'medicao_nova' ELSE event_type END AS event_type,
  <iso> AS "timestamp", lpad(CAST(user_id AS STRING), 7, '0') AS id_municipio,
  CAST(NULL AS STRING) AS sigla_uf, CAST(1995 + event_id % 7 AS INT) AS ano, <value> AS taxa_alfabetizacao,
  CAST(30 + event_id % 50 AS DOUBLE) AS meta"""
_EVENT_ID = """
  CASE WHEN event_type = 'signup' THEN CAST(event_id AS STRING) ELSE
    concat(substr(md5(CAST(event_id AS STRING)), 1, 8), '-', substr(md5(CAST(event_id AS STRING)), 9, 4), '-',
           substr(md5(CAST(event_id AS STRING)), 13, 4), '-', substr(md5(CAST(event_id AS STRING)), 17, 4), '-',
           substr(md5(CAST(event_id AS STRING)), 21, 12)) END AS event_id,"""

# Each name with its SELECT; {x} stands for the table or the other entity x.
SOURCES = {
    # State directory: one copy per customer, written in several ways
    "fx_uf": """
SELECT CAST(n_nationkey AS STRING) AS id_uf,
       CASE WHEN c_acctbal < 0 THEN concat('  ', lower(n_name), ' ') ELSE n_name END AS sigla,
       concat(' ', lower(n_name)) AS nome, concat(r_name, ' ') AS regiao
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # Municipality directory: unpadded keys, some keys no fact knows, some rows listed twice
    "fx_municipio": """
SELECT CASE WHEN c_custkey % 13 = 0 THEN concat('X', CAST(c_custkey AS STRING))
            ELSE CAST(c_custkey AS STRING) END AS id_municipio,
       concat(' ', lower(n_name)) AS sigla_uf, lower(c_name) AS nome, r_name AS nome_uf
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
UNION ALL
SELECT CASE WHEN c_custkey % 13 = 0 THEN concat('X', CAST(c_custkey AS STRING))
            ELSE CAST(c_custkey AS STRING) END, n_name, concat('of ', lower(c_name)), r_name
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
WHERE c_acctbal < 0""",
    # Municipal targets: null rates, null and wrong state codes
    "fx_meta_municipio": f"""
SELECT CAST(year(o_orderdate) AS INT) AS ano, CAST(o_custkey AS STRING) AS id_municipio,
       CASE WHEN o_custkey % 17 = 0 THEN 'NATION_X' WHEN o_custkey % 7 = 0 THEN NULL ELSE n_name END AS sigla_uf,
       o_orderstatus AS rede,
       CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE CAST(round(CAST(max(o_totalprice) AS DECIMAL(18,2))
         * CAST(0.00021 AS DECIMAL(7,5)), 2) AS DOUBLE) END AS taxa_alfabetizacao,
       {_targets("o_custkey")},
       CAST(o_custkey % 5 AS STRING) AS nivel_alfabetizacao,
       CAST(50 + o_custkey % 50 AS DOUBLE) AS percentual_participacao
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey
GROUP BY o_custkey, year(o_orderdate), o_orderstatus, n_name""",
    # State targets: several rows per key, as the code is written in two ways
    "fx_meta_uf": f"""
SELECT CAST(year(o_orderdate) AS INT) AS ano,
       CASE WHEN o_totalprice < 150000 THEN concat(' ', lower(n_name)) ELSE n_name END AS sigla_uf,
       o_orderstatus AS rede, {_URGENT} AS taxa_alfabetizacao,
       {_targets("n_nationkey")},
       CAST(60 + n_nationkey AS DOUBLE) AS percentual_participacao
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey
GROUP BY year(o_orderdate), n_name, n_nationkey, o_orderstatus, o_totalprice < 150000,
         CASE WHEN o_totalprice < 150000 THEN concat(' ', lower(n_name)) ELSE n_name END""",
    # National targets: two rows per key
    "fx_meta_brasil": f"""
SELECT CAST(year(o_orderdate) AS INT) AS ano, o_orderstatus AS rede, {_URGENT} AS taxa_alfabetizacao,
       {_targets("CAST(year(o_orderdate) AS INT)")},
       CASE WHEN o_totalprice < 150000 THEN CAST(70 AS DOUBLE) ELSE CAST(80 AS DOUBLE) END
         AS percentual_participacao
FROM {{orders}}
GROUP BY year(o_orderdate), o_orderstatus, o_totalprice < 150000,
         CASE WHEN o_totalprice < 150000 THEN CAST(70 AS DOUBLE) ELSE CAST(80 AS DOUBLE) END""",
    # Students: repeated ids, flags to derive, scores that are no numbers
    "fx_alunos": """
SELECT CAST(year(l_shipdate) AS INT) AS ano, CAST(o_custkey AS STRING) AS id_municipio,
       CAST(l_suppkey AS STRING) AS id_escola,
       concat(' ', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id_aluno,
       CAST(l_partkey AS STRING) AS caderno, CAST(2 + l_linenumber % 2 AS STRING) AS serie,
       l_linestatus AS rede, l_returnflag AS presenca, CAST(NULL AS STRING) AS preenchimento_caderno,
       CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '0' ELSE NULL END AS alfabetizado,
       CASE WHEN l_partkey % 23 = 0 THEN 'n/d' WHEN l_partkey % 19 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN '-1'
            ELSE CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.0095 AS DECIMAL(6,4)), 2)
                 AS DECIMAL(18,2)) AS STRING) END AS proficiencia,
       l_quantity AS peso_aluno
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    # Events: those of type "error" are sent again an hour later with another value
    "fx_eventos": f"""
SELECT {_EVENT_ID} {_EVENT.replace("<iso>", "<iso0>").replace("<value>", "value")}
FROM {{events}}
UNION ALL
SELECT {_EVENT_ID} {_EVENT.replace("<iso>", "<iso1>").replace("<value>", "value + 1")}
FROM {{events}} WHERE event_type = 'error'""",
    # Municipal targets as they pile up over two loads
    "fx_snapshots": f"""
SELECT *, TIMESTAMP '2026-07-12 00:00:00' AS _ingestion_timestamp FROM {{fx_meta_municipio}}
UNION ALL
SELECT ano, id_municipio, sigla_uf, rede, taxa_alfabetizacao - 1 AS taxa_alfabetizacao,
       {", ".join(TARGETS)}, nivel_alfabetizacao, percentual_participacao,
       TIMESTAMP '2026-07-11 00:00:00' AS _ingestion_timestamp
FROM {{fx_meta_municipio}} WHERE ano < 2001""",
}



def _key(x: str) -> str:
    return f"CASE WHEN length({x}) < 7 THEN lpad({x}, 7, '0') ELSE {x} END"


# The raw entities as an origin delivers them that meets the rules of the raw layer. What is left is for the clean layer to find: copies, missing
# targets, keys without a directory entry, scores that are no numbers.
SOURCES |= {
    "ok_uf": "SELECT id_uf, upper(trim(sigla)) AS sigla, min(nome) AS nome, min(regiao) AS regiao FROM {fx_uf} GROUP BY id_uf, upper(trim(sigla))",
    "ok_municipio": f"SELECT {_key("replace(id_municipio, 'X', '9')")} AS id_municipio, sigla_uf, nome, nome_uf FROM {{fx_municipio}}",
    "ok_meta_brasil": "SELECT * FROM {fx_meta_brasil}",
    "ok_meta_uf": "SELECT * FROM {fx_meta_uf}",
    "ok_meta_municipio": f"""SELECT ano, {_key("id_municipio")} AS id_municipio, rede,
  CASE WHEN taxa_alfabetizacao > 100 THEN CAST(100 AS DOUBLE) ELSE taxa_alfabetizacao END AS taxa_alfabetizacao,
  {", ".join(TARGETS)}, nivel_alfabetizacao, percentual_participacao FROM {{fx_meta_municipio}}""",
    "ok_alunos": f"""SELECT ano, {_key("id_municipio")} AS id_municipio, id_escola, id_aluno, caderno, serie, rede, presenca,
  preenchimento_caderno, alfabetizado, proficiencia, peso_aluno FROM {{fx_alunos}}""",
}

_ISO = {
    "spark": """date_format(CAST(<ts> AS TIMESTAMP), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")""",
    "duckdb": "strftime(<ts>, '%Y-%m-%dT%H:%M:%S.%f+00:00')",
}


def _dialect(text: str, engine: str) -> str:
    iso = _ISO[engine]
    text = text.replace("<iso0>", iso.replace("<ts>", "ts"))
    text = text.replace("<iso1>", iso.replace("<ts>", "ts + INTERVAL 1 HOUR"))
    return text.replace('"timestamp"', "`timestamp`") if engine == "spark" else text


def needs(text: str) -> list[str]:
    return re.findall(r"\{([a-z]\w*)\}", text)


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(BASE_TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str, known: dict[str, DataFrame] | None = None) -> DataFrame:
    """A given table or a raw entity as a DataFrame; ``known`` keeps those already built."""
    known = {} if known is None else known
    if name not in known:
        if name in BASE_TABLES:
            known[name] = given(spark, sf_dir, name)
        else:
            text = _dialect(SOURCES[name], "spark")
            known[name] = spark.sql(text, **{dep: source(spark, sf_dir, dep, known) for dep in needs(text)})
    return known[name]


def source_sql(name: str) -> str:
    """The SELECT of a raw entity for the checking engine; names stand for themselves."""
    return re.sub(r"\{([a-z]\w*)\}", r"\1", _dialect(SOURCES[name], "duckdb"))
