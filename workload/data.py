"""Derived tables the queries start from, each a lazy plan over the given tables."""

from __future__ import annotations

import re
import tempfile
from datetime import datetime, timezone
from functools import cached_property
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.contracts import INTEGRATED_ENTITY, conform_present, schema_for
from lodestrata.functions.numbers import lenient_double
from lodestrata.functions.text import text_key, pad_key
from lodestrata.functions.targets import derived_flag
from lodestrata.operators import entities, integrate
from lodestrata.session import apply_settings, materialise, work_folder
from workload.fixtures import YEARS, source

RUN_TS = datetime(2026, 7, 12, 10, 30, tzinfo=timezone.utc)
EARLIER_TS = datetime(2026, 7, 11, 10, 30, tzinfo=timezone.utc)


def own_shared_folder(spark: SparkSession) -> None:
    """For a try-out in one process whose session names no shared folder: a folder of this application's own."""
    if spark.conf.get("spark.checkpoint.dir", None) is None and re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        spark.conf.set("spark.checkpoint.dir", Path(tempfile.mkdtemp(prefix="lodestrata-")).as_uri())


class Data:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_settings(spark)
        self.sf_dir = sf_dir
        self._known: dict[str, DataFrame] = {}
        own_shared_folder(spark)

    def raw(self, name: str) -> DataFrame:
        return source(self.spark, self.sf_dir, name, self._known)

    def keep(self, name: str) -> None:
        """Stores a raw entity that several derivations read, so that it is derived once."""
        self._known[name] = materialise(self.raw(name), name)

    def folder(self, label: str) -> str:
        return work_folder(self.spark, label)

    @cached_property
    def uf(self) -> DataFrame:
        return entities.clean_uf(self.raw("fx_uf"))

    @cached_property
    def municipio(self) -> DataFrame:
        """Stored, as the jobs find it: it is looked up several times, and its size is then known."""
        return materialise(entities.clean_municipio(self.raw("fx_municipio")), "municipio")

    @cached_property
    def meta_brasil(self) -> DataFrame:
        return entities.clean_meta_brasil(self.raw("fx_meta_brasil"))

    @cached_property
    def meta_uf(self) -> DataFrame:
        return materialise(entities.clean_meta_uf(self.raw("fx_meta_uf")), "meta_uf")

    @cached_property
    def meta_municipio(self) -> DataFrame:
        return entities.clean_meta_municipio(self.raw("fx_snapshots"), self.municipio)

    @cached_property
    def alunos(self) -> DataFrame:
        return entities.clean_alunos(self.raw("fx_alunos"))

    @cached_property
    def events_clean(self) -> DataFrame:
        return entities.clean_events(self.raw("fx_eventos"))

    @cached_property
    def students_typed(self) -> DataFrame:
        """Students before duplicates are removed."""
        score = lenient_double(F.col("proficiencia"))
        return self.raw("fx_alunos").select(
            "ano",
            pad_key(F.col("id_municipio")).alias("id_municipio"),
            "id_escola",
            text_key(F.col("id_aluno")).alias("id_aluno"),
            "serie",
            "rede",
            derived_flag(F.col("alfabetizado"), score).alias("alfabetizado"),
            score.alias("proficiencia"),
            "peso_aluno",
        )

    @cached_property
    def batch(self) -> DataFrame:
        return integrate.integrate_batch(self.meta_municipio, self.municipio, self.meta_uf)

    @cached_property
    def valid(self) -> DataFrame:
        return integrate.referential_split(self.batch)[0]

    def merged(self, network: str) -> DataFrame:
        return integrate.merge_events(self.valid, self.raw("fx_eventos"), self.municipio, self.meta_uf, network)

    @cached_property
    def integrated(self) -> DataFrame:
        """The integrated table as the views find it: stored, so that none computes it twice."""
        contract = schema_for(INTEGRATED_ENTITY, "silver", YEARS, lineage=False)
        return materialise(conform_present(self.merged(integrate.EVENT_NETWORK), contract), "integrated")
