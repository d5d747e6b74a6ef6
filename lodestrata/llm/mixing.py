"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.shared import WORD, numbered, stored, whole

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: The random offset is a fraction of this many steps, so that it adds to whole numbers without rounding.
STEPS = 1 << 20


def word_count(text: str = "text") -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Per source: its size, and its target size.

    Sources are ordered by code point, null last, and weigh ``weights`` in turn; together they get the size of all rows. No
    target is above ``most`` times the source's size: what is above is shared out again by weight. In the order of size over
    weight the sources at their limit come first, so one running sum finds them all. One row per source, already summed.
    """
    sums = sized.groupBy("__source").agg(F.sum("__size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    order = Window.orderBy(F.col("__source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rated = sums.withColumn("weight", weight).withColumn("limit", most * F.col("source_size"))
    tight = Window.orderBy(F.col("limit") / F.col("weight"), F.col("__source").asc_nulls_last())
    earlier, all_rows = tight.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("limit").over(earlier), F.lit(0))
    share = left / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
    rated = rated.withColumn("share", share)
    # The first source that its share doesn't fill tells what all from there on get by weight; those before it are full.
    whole_order = tight.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    open_share = F.first(F.when(F.col("limit") > F.col("share") * F.col("weight"), F.col("share")), ignorenulls=True).over(whole_order)
    target = F.least(F.col("limit").cast("double"), F.col("weight") * open_share)
    return rated.select("__source", "source_size", target.alias("target"))


def mix(docs: DataFrame, seed: int = 17, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with size, source_size, target and copies: how often the mix takes each row.

    Every row of a source expects target / source_size copies. The expected copies are summed in the order of size, then one
    random offset per source is added, and a row is taken once for every whole number that its interval crosses. As sizes
    ascend in that order, the words taken differ from the target by little more than one long document.

    Null texts have size 0; rows without words may be taken and add nothing. A source without words has target 0 and is not
    taken. Null sources form a source of their own. Repeated rows count each. An empty table gives an empty one. Columns of ``docs``
    named like an added one are replaced, all others may have any names. The same rows give the same mix. Windows over the
    sources run in one task, over one row per source.
    """
    extra = ("size", "source_size", "target", "copies")
    names = [c for c in docs.columns if c not in extra]
    base = docs.select(*(F.col(f"`{c}`").alias(f"in_{c}") for c in names)).withColumns({"__source": F.col(f"in_{source}"), "__size": word_count(f"in_{text}")})
    targets = stored(source_targets(base.select("__source", "__size"), weights, most), "mix-targets")
    targets = targets.withColumnRenamed("__source", "__name")
    rows = base.join(targets, F.col("__source").eqNullSafe(F.col("__name")), "left")
    bits = F.length(F.bin("__size"))
    band = bits * 16 + F.floor(F.col("__size") / F.pow(F.lit(2.0), F.greatest(bits - 4, F.lit(0)))).cast("int")
    ranked = numbered(rows, ["__source"], f"in_{id_col}", ["__size", F.col(f"in_{id_col}"), F.xxhash64(f"in_{text}")], band, "__rank")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("__source", F.lit("\0")))), 1, 5), 16, 10).cast("double") / STEPS
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(F.col("__rank") * rate + offset) - F.floor((F.col("__rank") - 1) * rate + offset)
    ranked = ranked.withColumn("copies", F.least(crossed, F.lit(most)).cast("long"))
    return ranked.select(*(F.col(f"`in_{c}`").alias(c) for c in names), "source_size", "target", "copies", F.col("__size").alias("size"))


def take(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as it is taken, in the columns of ``docs``."""
    mixed = mix(docs.select(*(F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns)), id_col="in_doc_id", text="in_text", source="in_source", **options)
    taken = mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return taken.select(*(F.col(f"`in_{c}`").alias(c) for c in docs.columns))


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, 3 * source_size AS "limit" FROM s),
r AS (SELECT *, ((sum(source_size) OVER () - coalesce(sum("limit") OVER p, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0))::DOUBLE) AS share
      FROM w WINDOW p AS (ORDER BY "limit"::DOUBLE / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least("limit"::DOUBLE, weight * first_value(CASE WHEN "limit" > share * weight THEN share END IGNORE NULLS) OVER
             (ORDER BY "limit"::DOUBLE / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS target FROM r),
k AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, length(bin(d.size)) AS bits,
             ('0x' || substr(md5(d.doc_id::VARCHAR), 1, 8))::BIGINT % (SELECT greatest(1, (floor(sqrt(max(n))) + 15)::BIGINT // 16) FROM s) AS lane
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY bits * 16 + floor(size / pow(2.0, greatest(bits - 4, 0))), lane, size, doc_id) AS k,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
             ('0x' || substr(md5('17:' || coalesce(source, chr(0))), 1, 5))::BIGINT / {STEPS}.0::DOUBLE AS u FROM k)
SELECT doc_id, size, source_size, target, (size * least(floor(k * rate + u) - floor((k - 1) * rate + u), 3))::BIGINT AS taken FROM o
"""
