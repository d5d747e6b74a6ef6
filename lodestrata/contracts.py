"""Declared schemas, keys, partition layouts and volume bands of every table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructType, TimestampType

# --- Fixed values: entities, layers, lineage columns, column types, table contracts ---------

BATCH_ENTITIES = ("uf", "municipio", "meta_brasil", "meta_uf", "meta_municipio", "alunos")
DIRECTORY_ENTITIES = ("uf", "municipio")
EVENT_ENTITY = "indicador_alfabetizacao"
INTEGRATED_ENTITY = "municipio_indicador_completo"
GOLD_VIEWS = ("indicador_municipio", "meta_vs_resultado", "evolucao_temporal")

# Partition that holds the full date of a load, above all others
LOAD = "carga"
UNPARSABLE = "unparsable: "

TARGET_PREFIX = "meta_alfabetizacao_"
TARGET_YEARS = range(2024, 2031)

LINEAGE = {
    "bronze": (
        "_ingestion_timestamp TIMESTAMP NOT NULL, _ingestion_date STRING NOT NULL, "
        "_source_entity STRING NOT NULL, _job_name STRING NOT NULL, _record_hash STRING"
    ),
    "silver": "_silver_processed_at TIMESTAMP NOT NULL",
    "gold": "_gold_processed_at TIMESTAMP NOT NULL",
}

BUSINESS_KEYS = {
    "uf": ("sigla_uf",),
    "municipio": ("id_municipio",),
    "meta_brasil": ("ano", "rede"),
    "meta_uf": ("sigla_uf", "ano", "rede"),
    "meta_municipio": ("id_municipio", "ano", "rede"),
    "alunos": ("id_aluno", "ano"),
    EVENT_ENTITY: ("event_id",),
    INTEGRATED_ENTITY: ("id_municipio", "ano", "rede"),
}

# Declared schemas as DDL; {targets} stands for a DOUBLE column per target year.
CONTRACTS = {
    ("uf", "bronze"): "id_uf STRING, sigla STRING, nome STRING, regiao STRING",
    ("uf", "silver"): "id_uf STRING NOT NULL, sigla_uf STRING NOT NULL, nome_uf STRING NOT NULL, regiao STRING",
    ("uf", "gold"): "sigla_uf STRING NOT NULL, nome_uf STRING NOT NULL, regiao STRING",
    ("municipio", "bronze"): "id_municipio STRING, sigla_uf STRING, nome STRING, nome_uf STRING",
    ("municipio", "silver"): (
        "id_municipio STRING NOT NULL, sigla_uf STRING NOT NULL, nome_municipio STRING NOT NULL, "
        "nome_uf STRING"
    ),
    ("municipio", "gold"): "id_municipio STRING NOT NULL, sigla_uf STRING NOT NULL, nome_municipio STRING NOT NULL",
    ("meta_brasil", "bronze"): "ano INT, rede STRING, taxa_alfabetizacao DOUBLE, {targets}, percentual_participacao DOUBLE",
    ("meta_brasil", "silver"): (
        "ano INT NOT NULL, rede STRING NOT NULL, taxa_alfabetizacao DOUBLE, {targets}, "
        "percentual_participacao DOUBLE"
    ),
    ("meta_brasil", "gold"): (
        "ano INT NOT NULL, rede STRING NOT NULL, taxa_alfabetizacao DOUBLE, meta_vigente DOUBLE, "
        "gap_meta DOUBLE, atingiu_meta BOOLEAN"
    ),
    ("meta_uf", "bronze"): (
        "ano INT, sigla_uf STRING, rede STRING, taxa_alfabetizacao DOUBLE, {targets}, "
        "percentual_participacao DOUBLE"
    ),
    ("meta_uf", "silver"): (
        "ano INT NOT NULL, sigla_uf STRING NOT NULL, rede STRING NOT NULL, taxa_alfabetizacao DOUBLE, "
        "{targets}, percentual_participacao DOUBLE"
    ),
    ("meta_uf", "gold"): (
        "ano INT NOT NULL, sigla_uf STRING NOT NULL, taxa_alfabetizacao DOUBLE, meta_vigente DOUBLE, "
        "gap_meta DOUBLE, atingiu_meta BOOLEAN"
    ),
    ("meta_municipio", "bronze"): (
        "ano INT, id_municipio STRING, rede STRING, taxa_alfabetizacao DOUBLE, {targets}, "
        "nivel_alfabetizacao STRING, percentual_participacao DOUBLE"
    ),
    ("meta_municipio", "silver"): (
        "ano INT NOT NULL, id_municipio STRING NOT NULL, sigla_uf STRING, rede STRING NOT NULL, "
        "taxa_alfabetizacao DOUBLE, {targets}, nivel_alfabetizacao STRING, "
        "percentual_participacao DOUBLE, gap_meta DOUBLE, atingiu_meta BOOLEAN"
    ),
    ("meta_municipio", "gold"): (
        "ano INT NOT NULL, id_municipio STRING NOT NULL, sigla_uf STRING NOT NULL, "
        "nome_municipio STRING, taxa_alfabetizacao DOUBLE, meta_vigente DOUBLE, gap_meta DOUBLE, "
        "atingiu_meta BOOLEAN, delta_anual DOUBLE"
    ),
    ("alunos", "bronze"): (
        "ano INT, id_municipio STRING, id_escola STRING, id_aluno STRING, caderno STRING, serie STRING, "
        "rede STRING, presenca STRING, preenchimento_caderno STRING, alfabetizado STRING, "
        "proficiencia DOUBLE, peso_aluno DOUBLE"
    ),
    ("alunos", "silver"): (
        "ano INT NOT NULL, id_municipio STRING NOT NULL, id_escola STRING, id_aluno STRING NOT NULL, "
        "serie STRING, rede STRING, alfabetizado STRING, proficiencia DOUBLE, peso_aluno DOUBLE"
    ),
    ("alunos", "gold"): (
        "ano INT NOT NULL, id_municipio STRING NOT NULL, total_alunos BIGINT NOT NULL, "
        "total_alfabetizados BIGINT NOT NULL, taxa_alfabetizacao_calc DOUBLE"
    ),
    (EVENT_ENTITY, "bronze"): (
        "event_id STRING, event_type STRING, timestamp STRING, id_municipio STRING, sigla_uf STRING, "
        "ano INT, taxa_alfabetizacao DOUBLE, meta DOUBLE"
    ),
    (INTEGRATED_ENTITY, "silver"): (
        "ano INT, id_municipio STRING, sigla_uf STRING, rede STRING, taxa_alfabetizacao DOUBLE, "
        "{targets}, nivel_alfabetizacao STRING, percentual_participacao DOUBLE, gap_meta DOUBLE, "
        "atingiu_meta BOOLEAN, nome_municipio STRING, nome_uf STRING, indicador_uf DOUBLE, "
        "event_id STRING, _source_type STRING"
    ),
    ("indicador_municipio", "gold"): (
        "id_municipio STRING, nome STRING, sigla_uf STRING, nome_uf STRING, ano INT, rede STRING, "
        "pct_alfabetizados DOUBLE, meta_pct DOUBLE, gap_meta DOUBLE, atingiu_meta BOOLEAN, "
        "indicador_uf DOUBLE, nivel_alfabetizacao STRING, percentual_participacao DOUBLE, "
        "total_alunos_avaliados BIGINT"
    ),
    ("meta_vs_resultado", "gold"): (
        "sigla_uf STRING, ano INT, taxa_media DOUBLE, meta_media DOUBLE, gap_medio DOUBLE, "
        "municipios_total BIGINT, municipios_acima_meta BIGINT, municipios_abaixo_meta BIGINT, "
        "ranking_taxa INT, taxa_anterior DOUBLE, delta_percentual DOUBLE, regiao STRING, nome_uf STRING"
    ),
    ("evolucao_temporal", "gold"): (
        "id_municipio STRING, nome STRING, sigla_uf STRING, nome_uf STRING, rede STRING, ano INT, "
        "pct_alfabetizados DOUBLE, pct_anterior DOUBLE, delta_percentual DOUBLE, delta_anual DOUBLE, "
        "meta_pct DOUBLE, gap_meta DOUBLE, atingiu_meta BOOLEAN"
    ),
}

# Columns each analytic view must have before it is published.
REQUIRED_VIEW_COLUMNS = {
    "indicador_municipio": ("id_municipio", "pct_alfabetizados", "meta_pct", "gap_meta"),
    "meta_vs_resultado": ("sigla_uf", "ano", "taxa_media", "gap_medio"),
    "evolucao_temporal": ("id_municipio", "ano", "pct_alfabetizados", "delta_percentual"),
}

# Expected row counts (lowest, highest) per published table.
VOLUME_BANDS = {
    "meta_brasil": (1, 10),
    "meta_uf": (50, 120),
    "meta_municipio": (10_000, 11_000),
    "alunos": (3_000_000, 4_000_000),
    "silver_meta_municipio": (10_000, 11_000),
    "silver_alunos": (3_000_000, 4_000_000),
    "silver_municipio_indicador_completo": (10_000, 11_000),
    "gold_indicador_municipio": (10_000, 11_000),
    "gold_meta_vs_resultado": (40, 60),
    "gold_evolucao_temporal": (10_000, 11_000),
}

# --- End of fixed values ---------------------------------------------------------------------

_TYPES = {
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "DOUBLE": DoubleType(),
    "BOOLEAN": BooleanType(),
    "TIMESTAMP": TimestampType(),
    "STRING": StringType(),
}


class ContractError(ValueError):
    """A table does not have the columns its contract declares."""


def struct_of(ddl: str) -> StructType:
    """The StructType of a DDL string; works without a session. An unknown type is an error."""
    schema = StructType()
    for column in ddl.split(", "):
        name, kind, *rest = column.split(" ")
        if kind not in _TYPES or rest not in ([], ["NOT", "NULL"]):
            raise ContractError(f"not a column of a contract: {column}")
        schema = schema.add(name, _TYPES[kind], nullable=not rest)
    return schema


def schema_for(
    entity: str, layer: str, target_years: Iterable[int] = TARGET_YEARS, lineage: bool = True
) -> StructType:
    """The declared schema of ``entity`` in ``layer``; KeyError when none is declared."""
    layer = layer.lower()
    if not any(known == entity for known, _ in CONTRACTS):
        raise KeyError(f"unknown entity: {entity}")
    if (entity, layer) not in CONTRACTS:
        raise KeyError(f"{entity} has no contract in layer {layer}")
    targets = ", ".join(f"{TARGET_PREFIX}{year} DOUBLE" for year in target_years)
    columns = [CONTRACTS[entity, layer].format(targets=targets)]
    if lineage:
        extra = ["_source_type STRING"] if (entity, layer) == (EVENT_ENTITY, "bronze") else []
        columns += [LINEAGE[layer], *extra]
    return struct_of(", ".join(columns))


def partition_columns(entity: str, layer: str) -> tuple[str, ...]:
    """The load's full date first, then year (raw data and directories), month and day. Events are appended, not loaded."""
    parts = ("ano", "mes", "dia") if layer.lower() == "bronze" or entity in DIRECTORY_ENTITIES else ("mes", "dia")
    return parts if entity == EVENT_ENTITY else (LOAD, *parts)


def stored_schema(
    entity: str, layer: str, target_years: Iterable[int] = TARGET_YEARS, lineage: bool = True
) -> StructType:
    """``schema_for`` plus the partition columns that live in the path (text, such as ``07``)."""
    schema = schema_for(entity, layer, target_years, lineage)
    for name in partition_columns(entity, layer):
        if name not in schema.fieldNames():
            schema = schema.add(name, "string")
    return schema


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the declared columns, in order, with the declared types; text that is no value of its type becomes null."""
    return conform_beside(df, schema, {})


def conform_beside(df: DataFrame, schema: StructType, extra: Mapping[str, Column]) -> DataFrame:
    """``conform``, with expressions over the columns as they were beside it."""
    missing = [name for name in schema.fieldNames() if name not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*typed, *(value.alias(name) for name, value in extra.items()))


def unparsable(df: DataFrame, schema: StructType) -> Column:
    """Names of the columns that hold something ``conform`` makes null, as text; null where there are none."""
    lost = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema.fields if f.name in df.columns]
    names = F.concat_ws(", ", *lost)
    return F.when(names != "", F.concat(F.lit(UNPARSABLE), names))


def conform_present(df: DataFrame, schema: StructType) -> DataFrame:
    """Like ``conform``, but a column the input lacks becomes a null of the declared type."""
    return df.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
