"""Checks over everything a lake has published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.contracts import BATCH_ENTITIES, EVENT_ENTITY, GOLD_VIEWS, INTEGRATED_ENTITY, VOLUME_BANDS
from lodestrata.operators import profile
from lodestrata.plans.jobs import Run
from lodestrata.sources.tables import optional_scan


def published(run: Run) -> dict[str, DataFrame]:
    """The tables the volume bands speak of: raw ones, and the last run of the others."""
    return {
        **{entity: run.bronze(entity) for entity in BATCH_ENTITIES},
        **{f"silver_{entity}": run.silver(entity) for entity in (*BATCH_ENTITIES, INTEGRATED_ENTITY)},
        **{f"gold_{view}": run.gold(view) for view in GOLD_VIEWS},
    }


def validate_lake(run: Run, bands: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """One row per check: volumes, key uniqueness, orphans, stored gaps, presence of events."""
    bands = VOLUME_BANDS if bands is None else bands
    tables = published(run)
    volumes = profile.volume_check({name: tables[name] for name in bands}, bands).select(
        F.concat(F.lit("volume_"), F.col("tabela")).alias("nome"),
        F.col("aprovado"),
        F.concat_ws(" ", F.lit("rows"), F.col("total"), F.lit("of"), F.col("minimo"), F.col("maximo")).alias("detalhe"),
    )
    events = optional_scan(run.spark, run.lake.bronze_stream(EVENT_ENTITY), run.stored(EVENT_ENTITY, "bronze"))
    integrated = tables[f"silver_{INTEGRATED_ENTITY}"]
    checks = {
        "dq_duplicidade_silver_municipio": profile.key_is_unique(tables["silver_municipio"], "id_municipio"),
        "dq_orfaos_integrado": profile.no_orphans(integrated),
        "dq_gap_meta_consistente": profile.gap_is_consistent(tables["gold_indicador_municipio"]),
        "dq_streaming_presente": profile.stream_present(integrated),
        # Whether raw events are stored at all is reported, not required.
        "dq_bronze_streaming": events.limit(1).agg(F.count(F.lit(1)).cast("int").alias("valor")),
    }
    rows = [
        check.select(
            F.lit(name).alias("nome"),
            (F.lit(name == "dq_bronze_streaming") | (F.col("valor") == 1)).alias("aprovado"),
            F.concat(F.lit("valor="), F.col("valor").cast("string")).alias("detalhe"),
        )
        for name, check in checks.items()
    ]
    return reduce(DataFrame.unionByName, [volumes, *rows])
