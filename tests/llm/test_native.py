"""Exact duplicates, mixing and shards against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

from conftest import rows
from llm_tables import empty, hard, table  # noqa: F401 - fixtures
from pyspark.sql import functions as F

from lodestrata.llm import exact_dedup, kd_shards, minhash_dedup, mixing
from lodestrata.llm.shared import numbered


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_exact_groups(hard, empty):
    groups = defaultdict(list)
    for i, t in texts(hard):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert rows(exact_dedup.exact_groups(hard)) == sorted(want, key=repr)
    assert exact_dedup.exact_groups(empty).count() == 0


def test_texts_with_one_hash_are_told_apart_by_their_bytes(table, monkeypatch):
    """With a hash of one value only the comparison of bytes is left."""
    real = exact_dedup.F.substring
    monkeypatch.setattr(exact_dedup.F, "substring", lambda c, a, b: exact_dedup.F.lit("00" * 16) if b == 32 else real(c, a, b))
    df = table([(1, "a", None, None), (2, "a", None, None), (3, "b", None, None)])
    assert rows(exact_dedup.exact_groups(df), "doc_id", "keep_id", "group_size") == [(1, 1, 2), (2, 1, 2), (3, 3, 1)]


def test_drop_exact_keeps_one_row_and_all_columns(hard, empty):
    kept = exact_dedup.drop_exact(hard)
    assert kept.columns == hard.columns and exact_dedup.drop_exact(empty).count() == 0
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in texts(hard)]
    assert kept.count() == len(set(normal))


def test_mix_matches_an_iterative_share_and_counts(hard, empty):
    mixed = mixing.mix(hard)
    found = mixed.select("doc_id", "source", "size", "source_size", "target", "copies").collect()
    sizes = defaultdict(int)
    for r in hard.collect():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, still = {}, float(sum(sizes.values())), set(order)
    while over := [s for s in still if left * weight[s] / sum(weight[x] for x in still) > 3 * sizes[s]]:
        target |= {s: 3 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        still -= set(over)
    target |= {s: left * weight[s] / sum(weight[x] for x in still) for s in still}
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.copies <= 3
        taken[r.source] += r["size"] * r.copies
    assert len(found) == hard.count()
    assert all(abs(taken[s] - target[s]) <= max(r["size"] for r in found) + 60 for s in taken)
    assert rows(mixed, "doc_id", "copies") == rows(mixing.mix(hard.repartition(5)), "doc_id", "copies")
    assert mixing.mix(empty).count() == 0


def test_take_repeats_whole_rows(hard):
    copies = mixing.mix(hard).selectExpr("sum(copies)").first()[0]
    taken = mixing.take(hard)
    assert taken.columns == hard.columns and taken.count() == copies


def test_numbered_is_gapless_and_ordered_in_a_hot_group(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "IF(id % 10 < 8, 'hot', NULL) AS g", "id % 7 AS v")
    got = numbered(df, ["g"], "doc_id", ["v", "doc_id"], band=df["v"])
    for g, n in (("hot", 4000), (None, 1000)):
        own = sorted((r["rank"], r.v) for r in got.collect() if r.g == g)
        assert [k for k, _ in own] == list(range(1, n + 1)) and [v for _, v in own] == sorted(v for _, v in own)


def test_shards_are_even_gapless_and_keep_equal_texts(spark, table, empty):
    docs = table([(i, f"text number {i % 900} " + "word " * (i % 900 % 37), "en", "a") for i in range(1800)])
    got = kd_shards.kd_shards(docs, leaves=8).collect()
    size, slots, of = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        of[r.doc_id % 900].add(r.shard)
    assert len(got) == 1800 and set(size) == set(range(8))
    assert max(size.values()) < 1.03 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of.values())
    assert kd_shards.kd_shards(empty, leaves=8).count() == 0


def test_each_cut_is_the_weighted_median_of_the_widest_dimension(spark):
    """Every node of the tree against a plain look at its rows; steps are heavy, so cuts go on into the hash of the text."""
    rnd = random.Random(6)
    fines = rnd.sample(range(1 << 32), 3000)
    points = [(i, rnd.randint(20, 60), 0, f << 20, [rnd.randint(0, 9) * 40, rnd.randint(0, 700), 5]) for i, f in enumerate(fines)]
    df = spark.createDataFrame(points, "id long, w long, crc long, fine long, bins array<int>")
    total, leaves = sum(p[1] for p in points), 11
    got = kd_shards.kd_split(df, leaves, total).collect()
    nodes = [(got, 0, leaves)]
    while nodes:
        own, base, count = nodes.pop()
        if count == 1:
            assert {r.shard for r in own} == {base}
            continue
        left, right = [r for r in own if r.shard < base + count // 2], [r for r in own if r.shard >= base + count // 2]
        spans = [max(r.bins[d] for r in own) - min(r.bins[d] for r in own) for d in range(3)]
        d = spans.index(max(spans))
        assert max((r.bins[d], r.fine) for r in left) < min((r.bins[d], r.fine) for r in right)
        share = sum(r.w for r in own) * (count // 2) / count
        assert abs(sum(r.w for r in left) - share) <= max(kd_shards.CLOSE * total / leaves, 60) / 2
        nodes += [(left, base, count // 2), (right, base + count // 2, count - count // 2)]
    assert len(got) == 3000


def test_columns_of_any_names_are_kept(hard):
    """Names that helpers use or used to use."""
    named = hard.withColumns({c: F.lit(c) for c in ("__id", "__hash", "__n", "__source", "__size", "__rank", "__lane", "in_text", "a.b", "gone", "hash")})
    for made in (exact_dedup.drop_exact(named), mixing.take(named), minhash_dedup.drop_near(named)):
        first = made.where("doc_id = 0").first()
        assert made.columns == named.columns and (first is None or (first["__id"], first["__source"], first["a.b"]) == ("__id", "__source", "a.b"))
    assert {"__source", "__size", "__rank"} < set(mixing.mix(named.drop("a.b")).columns)


def test_one_text_may_fill_several_shards(table):
    docs = table([(i, "the same text", "en", "a") for i in range(1000)] + [(5000 + i, f"other {i}", "en", "a") for i in range(500)])
    got = kd_shards.kd_shards(docs, target_bytes=7000).collect()
    size = defaultdict(int)
    for r in got:
        size[r.shard] += r["size"]
    assert len(got) == 1500 and max(size.values()) <= 7600


def test_shards_of_hard_rows(hard):
    got = rows(kd_shards.kd_shards(hard, leaves=4), "doc_id", "size")
    assert got == sorted([(i, len((t or "").encode()) + 16) for i, t in texts(hard)], key=repr)
