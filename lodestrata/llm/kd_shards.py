"""Shards by k-d tree: weighted medians along the widest metadata dimension (DataFrame functions only)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.shared import numbered, one_row, stored, whole

#: Steps of a coordinate between its least and its greatest value.
STEPS = 1024
#: Order inside a step: 32 bits of the text's hash, then 20 of the id's; refined by so many bits at a time.
TEXT_BITS, ID_BITS = (11, 11, 10), (10, 10)
#: A cut is fine enough if what lies in the step it falls into weighs less than this part of a shard.
CLOSE = 0.005
#: A run of equal texts is cut only if it weighs more than this part of a shard.
WHOLE_RUN = 0.02


def text_dimensions(text: str = "text") -> dict[str, Column]:
    """Metadata that depends on the text alone, so that equal texts lie at one point: size, lines, bytes per character."""
    size = F.octet_length(whole(text)).cast("double")
    lines = F.length(whole(text)) - F.length(F.replace(whole(text), F.lit("\n"), F.lit("")))
    return {"size": F.log2(size + 1), "lines": F.log2(lines + 1.0), "bytes_per_char": size / F.greatest(F.length(whole(text)), F.lit(1))}


def _at(values: list[int], first: int) -> Column:
    """The entry for a row's node, out of one number per node of the level that begins with node ``first``."""
    return F.element_at(F.lit(values), F.col("node") - first + 1)


def _weights(rows: DataFrame, *keys: str | Column) -> dict[int, dict[int, dict[int, int]]]:
    """Weight by node, first and second key. At most nodes x dimensions x steps rows come to the driver."""
    out: dict = {}
    for r in rows.groupBy("node", *keys).agg(F.sum("w").alias("w")).collect():
        out.setdefault(r[0], {}).setdefault(r[1], {})[r[2]] = r[3]
    return out


def _crossed(steps: dict[int, int], wanted: float) -> tuple[int, float, float]:
    """The step in which the weight wanted is reached, the weight before it and its own."""
    before = 0.0
    for step in sorted(steps):
        if before + steps[step] >= wanted:
            break
        before += steps[step]
    else:
        before -= steps[step]
    return step, before, steps[step]


def kd_split(points: DataFrame, leaves: int, total: int) -> DataFrame:
    """``points`` with the shard of each row. They hold bins (a step per dimension), fine (the order inside a step) and weight w.

    All nodes of a level are split together. One pass sums each node's weight by dimension and step; the dimension in which
    the node's rows spread widest is cut at the step where the weight reaches the share of its left leaves. Where that step
    is heavy, further passes refine the cut by the hash of the text, and only where one run of equal texts is heavier than
    ``WHOLE_RUN`` by the hash of the id. Each level is stored; a retried task reads it again.
    """
    counts, weights, bases = [leaves], [float(total)], [0]
    rows, first = points.withColumn("node", F.lit(1)), 1
    close = CLOSE * total / leaves
    while max(counts) > 1:
        there = [i for i, c in enumerate(counts) if c > 1]
        table = _weights(rows.where(F.col("node").isin([first + i for i in there])).select("node", "w", F.posexplode("bins").alias("dim", "bin")), "dim", "bin")
        # Rows of a node that is not cut are all below its bin.
        dims, bins, fines = [0] * len(counts), [STEPS] * len(counts), [0] * len(counts)
        low, rest = list(weights), {}
        for i in there:
            own = table[first + i]
            dims[i] = max(own, key=lambda d: (max(own[d]) - min(own[d]), -d))
            share = weights[i] * (counts[i] // 2) / counts[i]
            bins[i], low[i], heavy = _crossed(own[dims[i]], share)
            rest[i] = (share - low[i], heavy, sum(TEXT_BITS) + sum(ID_BITS))
        shift = sum(TEXT_BITS) + sum(ID_BITS)
        for width in (*TEXT_BITS, *ID_BITS):
            limit = close if shift > sum(ID_BITS) else total / leaves * WHOLE_RUN
            heavy = [i for i in there if rest[i][1] > limit and rest[i][2] == shift]
            if not heavy:
                break
            inside = F.element_at("bins", _at(dims, first) + 1) == _at(bins, first)
            same = F.shiftright("fine", shift) == F.shiftright(_at(fines, first), shift)
            shift -= width
            here = rows.where(F.col("node").isin([first + i for i in heavy])).where(inside & same)
            table = _weights(here.select("node", "w", F.lit(0).alias("all"), F.shiftright("fine", shift).alias("step")), "all", "step")
            for i in heavy:
                step, before, own = _crossed(table[first + i][0], rest[i][0])
                fines[i], low[i] = step << shift, low[i] + before
                rest[i] = (rest[i][0] - before, own, shift)
        for i, (wanted, own, at) in rest.items():  # what is left undivided goes to the side that it fits better
            if wanted > own / 2:
                bins[i], fines[i] = (bins[i] + 1, 0) if at == sum(TEXT_BITS) + sum(ID_BITS) else (bins[i], fines[i] + (1 << at))
                low[i] += own
        place = F.element_at("bins", _at(dims, first) + 1)
        lower = (place < _at(bins, first)) | ((place == _at(bins, first)) & (F.col("fine") < _at(fines, first)))
        rows = stored(rows.withColumn("node", 2 * F.col("node") + F.when(lower, 0).otherwise(1)), "shard-points")
        halves = [(c // 2, c - c // 2) if c > 1 else (c, 0) for c in counts]
        bases = [x for base, (one, _) in zip(bases, halves, strict=True) for x in (base, base + one)]
        weights = [x for w, part in zip(weights, low, strict=True) for x in (part, w - part)]
        counts = [c if weights[i] > 0 else min(c, 1) for i, c in enumerate(c for pair in halves for c in pair)]
        first *= 2
    return rows.withColumn("shard", _at(bases, first))


def kd_shards(docs: DataFrame, leaves: int | None = None, target_bytes: int | None = None, dimensions: dict[str, Column] | None = None, id_col: str = "doc_id", text: str = "text", overhead: int = 16) -> DataFrame:
    """One row per row of ``docs``: id, size (UTF-8 bytes plus ``overhead``), text_crc32, shard and slot (gapless from 0 in its shard).

    A k-d tree over ``dimensions`` (numbers; ``text_dimensions`` by default) is split at weighted medians along the widest
    dimension until there are ``leaves`` shards, or as many as make leaves of ``target_bytes``. Shards have near equal
    bytes: each level is off by less than half a percent of a shard, or half a row. Equal texts stay together unless a cut falls
    into a run heavier than that. Coordinates are taken in steps between the least and the greatest value over all rows.

    Null and empty texts weigh ``overhead``; a null dimension counts as its least value. Repeated rows count each. An empty table gives an
    empty result. With fewer rows than shards some shards stay empty. Other columns are not read.
    """
    if (leaves is None) == (target_bytes is None):
        raise ValueError("give either leaves or target_bytes")
    dimensions = text_dimensions(text) if dimensions is None else dimensions
    names = [f"dim{i}" for i in range(len(dimensions))]
    body = whole(text)
    raw = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(body) + overhead).cast("long").alias("w"),
        F.crc32(F.encode(body, "utf-8")).alias("crc"),
        (F.shiftleft(F.shiftrightunsigned(F.xxhash64(body), 32), sum(ID_BITS)) + F.pmod(F.xxhash64(F.col(id_col), F.lit("id")), F.lit(1 << sum(ID_BITS)))).alias("fine"),
        *(c.cast("double").alias(n) for n, c in zip(names, dimensions.values(), strict=True)),
    )
    raw = stored(raw, "shard-points")
    bounds = one_row(raw.agg(F.sum("w").alias("total"), *(f(n).alias(f"{f.__name__}_{n}") for n in names for f in (F.min, F.max))))
    total = bounds["total"] or 0
    leaves = leaves or max(1, math.ceil(total / target_bytes))
    steps = []
    for n in names:
        least, most = bounds[f"min_{n}"] or 0.0, bounds[f"max_{n}"] or 0.0
        scale = (STEPS - 1) / (most - least) if most > least else 0.0
        steps.append(F.coalesce(F.floor((F.col(n) - least) * scale).cast("int"), F.lit(0)).alias(n))
    points = raw.select("id", "w", "crc", "fine", F.array(*steps).alias("bins"))
    placed = kd_split(points, leaves, total) if total else points.withColumn("shard", F.lit(0))
    placed = placed.select(F.col("id").alias(id_col), F.col("w").alias("size"), F.col("crc").alias("text_crc32"), "shard")
    return numbered(placed, ["shard"], id_col, [F.col(id_col), "text_crc32"], None, "rank").withColumn("slot", F.col("rank") - 1).drop("rank")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write ``docs`` (ids unique) as one folder per shard."""
    id_col = options.get("id_col", "doc_id")
    places = kd_shards(docs, **options).select(F.col(id_col).alias("__id"), "shard", "slot")
    rows = docs.join(places, F.col(id_col).eqNullSafe(F.col("__id"))).drop("__id")
    rows.write.partitionBy("shard").parquet(path)
