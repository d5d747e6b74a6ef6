"""Exact duplicates by content hash, with a comparison of bytes (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.shared import SPACES, stored, whole


def normal_text(text: str = "text") -> Column:
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(whole(text), SPACES, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its group, the row of the group that stays and the hash of its normalised text.

    Rows are grouped by the first 128 bits of the SHA-256 of their normalised text. Counts and smallest ids are combined
    before the shuffle, so a group of any size costs a row per task. Bytes are compared by the least and the greatest text of
    every group with more than one row (equal exactly if all texts are), combined before the shuffle as well; a group in which
    they differ is grouped again by the texts themselves. The join back meets one row per group, so adaptive execution may split a hot group.

    Columns: ``id_col``, keep_id, group_size, kept, text_sha256. Null and empty texts form one group. Rows that repeat an id
    of the same group: all carry ``kept`` if it is the smallest id (``drop_exact`` keeps one of them). A null id is kept only where its
    group has no other id. An empty table gives an empty result. Columns of ``docs`` other than the two are not read.
    """
    keys = stored(docs.select(F.col(id_col).alias("id"), F.sha2(normal_text(text), 256).alias("sha")).withColumn("hash", F.unhex(F.substring("sha", 1, 32))), "exact-keys")
    sums = (F.min("id").alias("keep"), F.count(F.lit(1)).alias("n"))
    groups = stored(keys.groupBy("hash").agg(*sums).where("n > 1"), "exact-groups")

    texts = docs.select(F.col(id_col).alias("id"), normal_text(text).alias("norm")).withColumn("hash", F.unhex(F.substring(F.sha2("norm", 256), 1, 32)))
    spans = texts.join(groups.select("hash"), "hash", "left_semi").groupBy("hash").agg(F.min("norm").alias("least"), F.max("norm").alias("most"))
    collided = stored(spans.where("least <> most").select("hash"), "exact-collisions")

    sound = keys.join(collided, "hash", "left_anti").join(groups, "hash", "left")
    mixed = texts.join(collided, "hash", "left_semi")
    exact = mixed.groupBy("hash", "norm").agg(*sums)
    mixed = mixed.join(exact, ["hash", "norm"]).withColumn("sha", F.sha2("norm", 256))
    rows = sound.select("id", "sha", "keep", "n").unionByName(mixed.select("id", "sha", "keep", "n"))
    keep, size = F.coalesce("keep", "id"), F.coalesce("n", F.lit(1).cast("long"))
    return rows.select(F.col("id").alias(id_col), keep.alias("keep_id"), size.alias("group_size"), F.col("id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without later copies: all columns of the rows that stay, one row for each id that stays.

    Of rows that repeat a kept id with an equal text, the one whose other columns hash lowest stays. Rows of one id with
    different texts are told apart by the text. Null and empty texts are one group, very long ones are hashed whole, an empty
    table gives an empty one. Columns of ``docs`` may have any names.
    """
    kept = exact_groups(docs, id_col, text).where("kept").select(F.col(id_col).alias("id"), F.col("text_sha256").alias("sha")).distinct()
    rows = docs.select(*(F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns)).withColumn("hash", F.sha2(normal_text(f"in_{text}"), 256))
    same = F.col(f"in_{id_col}").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("sha"))
    rows = rows.join(kept, same, "left_semi")
    first = Window.partitionBy(f"in_{id_col}", "hash").orderBy(F.xxhash64(*[F.col(f"`in_{c}`") for c, t in docs.dtypes if not t.startswith("map")]))
    return rows.withColumn("place", F.row_number().over(first)).where("place = 1").select(*(F.col(f"`in_{c}`").alias(c) for c in docs.columns))
