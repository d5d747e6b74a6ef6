"""Near duplicates: banded MinHash candidates, sequential Bayesian pruning, exact confirmation."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from lodestrata.llm.components import components
from lodestrata.llm.filters import maybe_in
from lodestrata.llm.shared import give_back, id_parts, one_row, ship, stored
from lodestrata.llm.words import WordHashes, chained, shingles

BANDS, ROWS = 32, 6
#: Hashes compared at a time, and the chance of losing a pair at the threshold in one comparison.
BATCH, MISS = 32, 1e-6
#: Rows of a group that one task holds at a time.
BLOCK = 512
_KEPT = WordHashes()


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(20).integers(0, 1 << 63, size=(2, n, 1), dtype=np.uint64)
    return drawn[0] * np.uint64(2) + np.uint64(1), drawn[1]


def signature(values: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The least of each permutation's hashes, as 32 bits."""
    least = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint64)
    for i in range(0, len(values), 1024):
        np.minimum(least, ((values[None, i : i + 1024] * factors + offsets) >> np.uint64(32)).min(axis=1), out=least)
    return least


def least_matches(threshold: float, miss: float, step: int, n: int) -> dict[int, int]:
    """For each number of compared hashes, the matches below which the similarity is under ``threshold`` but for a chance of ``miss``.

    The prior of the similarity is uniform, so after m matches of k it is Beta(m + 1, k - m + 1), whose tail above the threshold is the
    chance of at most m successes in k + 1 trials.
    """
    out = {}
    for k in range(step, n + 1, step):
        tail = 0.0
        for m in range(k + 1):
            tail += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if tail >= miss:
                out[k] = m
                break
    return out


def plausible(left: np.ndarray, right: np.ndarray, bounds: dict[int, int]) -> np.ndarray:
    """Which rows of two signature arrays survive: batch by batch, rows below the bound leave."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), dtype=np.int64)
    done = 0
    for k, least in sorted(bounds.items()):
        matches[alive] += (left[alive, done:k] == right[alive, done:k]).sum(axis=1)
        alive, done = alive[matches[alive] >= least], k
    out = np.zeros(len(left), dtype=bool)
    out[alive] = True
    return out


def _stacked(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=np.uint16).reshape(len(blobs), -1)


def _similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def _texts_of(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts of ``nodes``; a filter drops the others before they are shuffled."""
    spark = texts.sparkSession
    wanted = maybe_in(spark, nodes.select(F.xxhash64("node").alias("key")))
    return texts.where(wanted(F.xxhash64("node"))).join(nodes, "node", "left_semi")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets are similar enough. A hot ``a`` is cut into blocks of its partners."""
    pairs = stored(pairs, "near-survivors")
    needed = stored(_texts_of(texts, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "near-texts")
    blocks = stored(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks")), "near-blocks")
    right = pairs.join(blocks, "a").withColumn("block", F.pmod(F.xxhash64("b"), "blocks")).drop("blocks")
    right = right.join(needed.select(F.col("node").alias("b"), F.col("text").alias("text")), "b")
    left = blocks.join(needed.select(F.col("node").alias("a"), F.col("text").alias("text")), "a")
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("a", "block", "text")
    right = right.select(F.col("a").alias("a"), F.col("b").alias("b"), F.col("block").alias("block"), "text")

    def compare(one: pd.DataFrame, many: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(one) and len(many):
            own = shingles(one["text"].iloc[0], size, _KEPT)
            found = [b for b, text in zip(many["b"], many["text"], strict=True) if _similar(own, shingles(text, size, _KEPT), percent)]
        return pd.DataFrame({"a": [one["a"].iloc[0]] * len(found) if found else [], "b": found}).astype("int64")

    return left.groupBy("a", "block").cogroup(right.groupBy("a", "block")).applyInPandas(compare, "a long, b long")


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, miss: float = MISS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id reachable over links) and kept.

    Two documents are linked if the intersection of their sets of ``size``-word shingles is at least ``percent`` of the union.

    1. Documents with equal sets are one class, held by its smallest id; everything below is done between classes.
    2. Classes that share a band of their signature are candidates. First each is compared with the smallest of its bucket;
       components of what is confirmed are formed; then all members of a bucket that lie in different components are
       compared, block by block. A bucket of any size whose members are alike thus costs a row each. Nothing is capped.
    3. Candidates are compared in batches of ``BATCH`` hashes and leave once the posterior chance of reaching the threshold is
       below ``miss``; survivors are confirmed on their whole sets (64-bit hashes of the shingles). Only links leave a task.

    A pair right at 80 % shares no band with a chance of 6e-5 (32 bands of 6), less above. Null and empty texts, and texts without words, have an empty set, are linked with
    nothing and kept; null ids too. Rows that share an id are one document. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    factors, offsets = _permutations(bands * rows)

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            ids = batch["id"].astype("Int64").where(batch["there"])
            for ident, there, body in zip(ids, batch["there"], batch["text"], strict=True):
                own = shingles(body, size, _KEPT)
                if not len(own) or not there:
                    out.append((ident, len(own), None, None, None))
                    continue
                sig = signature(own, factors, offsets)
                buckets = chained([np.arange(bands, dtype=np.uint64), *sig.reshape(bands, rows).T]).view(np.int64)
                key = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                out.append((ident, len(own), key, sig.astype(np.uint16).tobytes(), buckets.tolist()))
            yield pd.DataFrame(out, columns=["id", "n", "key", "sig", "buckets"]).astype({"id": "Int64"})
        _KEPT.clear()
        give_back()

    sets = stored(docs.select(*id_parts(id_col), F.col(text).alias("text")).mapInPandas(signed, "id long, n long, key binary, sig binary, buckets array<long>"), "near-sets")
    # Only keys that occur twice are grouped with their signatures; the filter tells the others without a shuffle.
    keyed = sets.where("key IS NOT NULL").withColumn("short", F.conv(F.hex(F.substring("key", 1, 7)), 16, 10).cast("long"))
    twice = stored(keyed.groupBy("key").agg(F.min("short").alias("short"), F.count(F.lit(1)).alias("n")).where("n > 1"), "near-equal")
    copied = maybe_in(spark, twice.select(F.xxhash64("short").alias("key")))
    flagged = keyed.withColumn("copied", copied(F.xxhash64("short")))
    grouped = flagged.where("copied").groupBy("key").agg(F.min("id").alias("node"), F.any_value("sig").alias("sig"), F.any_value("buckets").alias("buckets"))
    lone = flagged.where("NOT copied").select("key", F.col("id").alias("node"), "sig", "buckets")
    classes = stored(lone.unionByName(grouped), "near-classes")
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text).alias("text"))
    bounds = least_matches(percent / 100, miss, BATCH, bands * rows)

    @F.pandas_udf("boolean")
    def likely(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(plausible(_stacked(a), _stacked(b), bounds), dtype=bool) if len(a) else pd.Series([], dtype=bool)

    members = classes.select(F.posexplode("buckets").alias("band", "bucket"), "node")
    shared = members.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = stored(shared.where("a <> last").drop("last"), "near-shared")
    crowded = maybe_in(spark, shared.select(F.xxhash64("bucket").alias("key")))
    crowd = stored(members.where(crowded(F.xxhash64("bucket"))).join(shared, "bucket"), "near-crowd")
    stars = stored(crowd.where("a <> node").select("a", F.col("node").alias("b")).distinct(), "near-stars")
    met = maybe_in(spark, crowd.select(F.xxhash64("node").alias("key")).distinct())
    signs = stored(classes.where(met(F.xxhash64("node"))).select("node", "sig", "buckets"), "near-signs")
    sig = signs.select("node", "sig")
    pairs = stars.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b").where(likely("sig_a", "sig_b")).select("a", "b")
    links = stored(_confirmed(pairs, texts, size, percent), "near-links")
    found = stored(components(links), "near-components")

    placed = crowd.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stored(placed.select("band", "bucket", "node", "component", "n"), "near-placed")
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    mixed = stored(mixed.where("least <> most").select("bucket"), "near-mixed")
    inside = stored(placed.join(mixed, "bucket", "left_semi"), "near-inside")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    # Every block of a bucket meets every block, itself too: both sorted numbers are part of the group's key.
    spread = inside.join(signs, "node").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "band", "node", "component", "sig", "buckets")

    def dealt(table: DataFrame, n: int, rows_each: int) -> GroupedData:
        """The ``n`` rows grouped by a hash of their pair of blocks: most buckets hold few rows, so many pairs share a group of pandas; none is cut."""
        return table.groupBy(F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(1 + n // rows_each)).alias("part"))

    def ordered(group: pd.DataFrame) -> pd.DataFrame:
        names = ["bucket", "low", "high", "block", "node"]
        return group.sort_values(names).drop_duplicates(names).reset_index(drop=True)

    def surviving(group: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
        """For rows of ``ordered`` the later ones of the same two blocks that lie in another component, whose first shared band is this bucket's, and whose signature survives."""
        sigs, all_buckets = _stacked(group["sig"].tolist()), np.stack(group["buckets"].to_numpy())
        low, high, block, band, comps = (group[c].to_numpy() for c in ("low", "high", "block", "band", "component"))
        names = group[["bucket", "low", "high"]].to_numpy()
        ends = np.flatnonzero(np.r_[(names[1:] != names[:-1]).any(axis=1), True]) + 1
        start = 0
        for end in ends:
            cut = start + np.searchsorted(block[start:end], high[start])
            for i in range(start, end if low[start] == high[start] else cut):
                at = np.arange(max(i + 1, cut), end)
                at = at[comps[at] != comps[i]]
                if len(at):
                    at = at[(all_buckets[at] == all_buckets[i]).argmax(axis=1) == band[i]]
                if len(at):
                    at = at[plausible(np.broadcast_to(sigs[i], (len(at), bands * rows)), sigs[at], bounds)]
                if len(at):
                    yield i, at
            start = end

    def involved(group: pd.DataFrame) -> pd.DataFrame:
        """The members of two blocks that have a surviving partner there."""
        group = ordered(group)
        met = np.zeros(len(group), dtype=bool)
        for i, at in surviving(group):
            met[i] = met[at] = True
        return group[met]

    def across(group: pd.DataFrame) -> pd.DataFrame:
        """Links between members of a bucket that lie in different components, each pair in the first band it shares."""
        group = ordered(group)
        nodes, bodies = group["node"].tolist(), group["text"].tolist()
        found: list[tuple[int, int]] = []
        sets: dict[int, np.ndarray] = {}
        bucket = None
        for i, at in surviving(group):
            if bucket != group["bucket"].iat[i] or len(sets) > 2 * BLOCK:
                bucket = group["bucket"].iat[i]
                sets.clear()
            for k in (i, *at):
                if nodes[k] not in sets:
                    sets[nodes[k]] = shingles(bodies[k], size, _KEPT)
            found += [(min(nodes[i], nodes[k]), max(nodes[i], nodes[k])) for k in at if _similar(sets[nodes[i]], sets[nodes[k]], percent)]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    # Blocks meet as signatures; only members with a surviving partner are sent again with their texts.
    sent = one_row(inside.agg(F.sum(blocks).alias("n")))["n"] or 0
    met = stored(dealt(spread, sent, 4 * BLOCK).applyInPandas(involved, spread.schema), "near-involved")
    known = stored(_texts_of(texts, met.select("node").distinct()), "near-known")
    more = dealt(met.join(known, "node"), met.count(), BLOCK // 2).applyInPandas(across, "a long, b long")
    links = stored(links.unionByName(more), "near-links")
    reached = stored(components(links), "near-components")

    held_by = classes.select("key", "node").join(reached, "node", "left").select(F.col("key").alias("k"), F.coalesce("component", "node").alias("component"))
    out = sets.select("id", "n", "key").join(stored(held_by, "near-held"), F.col("key") == F.col("k"), "left")
    reach = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), reach.alias("component_id"), F.col("id").eqNullSafe(reach).alias("kept"))


def drop_near(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without near copies: of each component the document with the smallest id stays, with all its rows and columns.

    Rows with a null id, and those without words, stay. Very long texts are compared whole. Columns of ``docs`` may have any names.
    """
    gone = near_groups(docs, size, percent, id_col=id_col, text=text).where("NOT kept").select(F.col(id_col).alias("gone")).distinct()
    rows = docs.select(*(F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns))
    rows = rows.join(stored(gone, "near-gone"), F.col(f"in_{id_col}") == F.col("gone"), "left_anti")
    return rows.select(*(F.col(f"`in_{c}`").alias(c) for c in docs.columns))
