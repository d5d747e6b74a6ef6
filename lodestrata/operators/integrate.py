"""Batch rows joined to their directories, checked against them, and merged with events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.contracts import BUSINESS_KEYS, INTEGRATED_ENTITY
from lodestrata.functions.lineage import BATCH_SOURCE, STREAM_SOURCE, drop_technical
from lodestrata.operators.dedup import first_per_key
from lodestrata.operators.entities import clean_events, event_time, typed_events
from lodestrata.operators.quality import REASON

GRAIN = BUSINESS_KEYS[INTEGRATED_ENTITY]

# Reasons, and the network name events carry
NO_MUNICIPALITY = "municipio_inexistente"
OTHER_STATE = "uf_inconsistente"
EVENT_NETWORK = "total"


def municipality_lookup(municipio: DataFrame) -> DataFrame:
    """One row per municipality, its state code under a name of its own."""
    columns = ["id_municipio", "nome_municipio", "nome_uf", F.col("sigla_uf").alias("sigla_uf_municipio")]
    return first_per_key(municipio.select(*columns), ["id_municipio"])


def state_indicator(meta_uf: DataFrame, state_network: str | None = None) -> DataFrame:
    """One rate per state and year, so that the join cannot multiply rows: that of a network, or of the first by name."""
    chosen = meta_uf if state_network is None else meta_uf.where(F.col("rede") == state_network)
    rates = chosen.select("sigla_uf", "ano", "rede", F.col("taxa_alfabetizacao").alias("indicador_uf"))
    return first_per_key(rates, ["sigla_uf", "ano"]).drop("rede")


def _join_directories(
    df: DataFrame, municipio: DataFrame, meta_uf: DataFrame, fill_code: bool, state_network: str | None = None
) -> DataFrame:
    joined = df.join(municipality_lookup(municipio), "id_municipio", "left")
    own = "sigla_uf" in df.columns
    if not own or fill_code:
        code = F.col("sigla_uf_municipio")
        joined = joined.withColumn("sigla_uf", F.coalesce(F.col("sigla_uf"), code) if own else code)
    return joined.join(state_indicator(meta_uf, state_network), ["sigla_uf", "ano"], "left")


def integrate_batch(
    meta_municipio: DataFrame, municipio: DataFrame, meta_uf: DataFrame, state_network: str | None = None
) -> DataFrame:
    """Municipal targets with municipality names and the state's rate of the year.

    Give stored directories: their true size then decides how they are joined, before the facts are shuffled.
    """
    joined = _join_directories(meta_municipio, municipio, meta_uf, fill_code=False, state_network=state_network)
    return joined.withColumn("_source_type", F.lit(BATCH_SOURCE))


def enrich_events(
    events: DataFrame, municipio: DataFrame, meta_uf: DataFrame, network: str = EVENT_NETWORK
) -> DataFrame:
    """Events with the same attributes; works on a stream (stream-static joins) as on a table."""
    tagged = drop_technical(events).withColumns(
        {"rede": F.lit(network), "_source_type": F.lit(STREAM_SOURCE)}
    )
    return _join_directories(tagged, municipio, meta_uf, fill_code=True)


def orphans(df: DataFrame, municipio: DataFrame) -> DataFrame:
    return df.join(municipio.select("id_municipio"), "id_municipio", "left_anti")


def matched(df: DataFrame, municipio: DataFrame) -> DataFrame:
    return df.join(municipio.select("id_municipio"), "id_municipio", "left_semi")


def split_orphans(integrated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a municipality, rows without) of an integrated table."""
    name = F.col("nome_municipio")
    return integrated.where(name.isNotNull()), integrated.where(name.isNull())


def referential_reason(null_is_mismatch: bool = False) -> Column:
    """Why a row does not fit its municipality; null when it fits."""
    own, other = F.col("sigla_uf"), F.col("sigla_uf_municipio")
    differs = ~own.eqNullSafe(other) if null_is_mismatch else own != other
    return F.when(F.col("nome_municipio").isNull(), F.lit(NO_MUNICIPALITY)).when(
        other.isNotNull() & differs, F.lit(OTHER_STATE)
    )


def with_referential_reason(integrated: DataFrame, null_is_mismatch: bool = False) -> DataFrame:
    return integrated.withColumn(REASON, referential_reason(null_is_mismatch))


def referential_split(integrated: DataFrame, null_is_mismatch: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows set aside with their reason)."""
    judged = with_referential_reason(integrated, null_is_mismatch)
    return judged.where(F.col(REASON).isNull()).drop(REASON), judged.where(F.col(REASON).isNotNull())


def union_sources(batch: DataFrame, events: DataFrame) -> DataFrame:
    """Both sources under the union of their columns; what one of them lacks is null."""
    return batch.unionByName(events, allowMissingColumns=True)


def precedence_order(df: DataFrame) -> list[Column]:
    """Events before batch rows, later events before earlier ones."""
    streaming_first = F.when(F.col("_source_type") == STREAM_SOURCE, 0).otherwise(1).asc()
    newest = [event_time().desc_nulls_last()] if "timestamp" in df.columns else []
    return [streaming_first, *newest]


def merge_precedence(batch: DataFrame, enriched_events: DataFrame) -> DataFrame:
    """One row per municipality, year and network: the latest event if there is one, else the batch row."""
    both = union_sources(batch, enriched_events)
    return first_per_key(both, GRAIN, precedence_order(both))


def merge_events(
    batch: DataFrame,
    events: DataFrame,
    municipio: DataFrame,
    meta_uf: DataFrame,
    network: str = EVENT_NETWORK,
    one_per_id: bool = False,
) -> DataFrame:
    """Raw events cleaned, enriched and merged over the batch rows. ``one_per_id`` says that the events are settled already."""
    clean = typed_events(events) if one_per_id else clean_events(events)
    return merge_precedence(batch, enrich_events(clean, municipio, meta_uf, network))
