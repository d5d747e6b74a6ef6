"""Near duplicates and nearest neighbours against brute force, and the pipeline stage by stage."""

import random
from collections import defaultdict

import numpy as np
import pytest
from conftest import plan, rows
from llm_tables import empty, hard, table  # noqa: F401 - fixtures

import corpus_pipeline
from lodestrata.llm import components, language_id, minhash_dedup, mixing, neighbours, shared


def plain_groups(pairs, size, percent):
    """Components over all pairs, by sets of word runs."""
    sets = {}
    for i, t in pairs:
        words = [w.decode() for w in (t or "").encode().lower().split()]
        n = min(size, len(words))
        sets.setdefault(i, set()).update(tuple(words[j : j + n]) for j in range(len(words) - n + 1) if n)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if i is not None)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def varied(rnd, words, changes):
    out = list(words)
    for at in rnd.sample(range(len(out)), changes):
        out[at] = f"w{rnd.randint(0, 10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("size", [4, 5])
def test_near_groups_equal_brute_force(table, size):
    """A chain whose ends are no match, a large group of near copies, copies, borderline pairs, short texts and shared passages."""
    rnd = random.Random(size)
    fresh = lambda n: [f"w{rnd.randint(0, 10**6)}" for _ in range(n)]
    texts, base = [], fresh(200)
    texts += [varied(rnd, base, rnd.randint(0, 4)) for _ in range(60)]
    chain = fresh(150)
    for _ in range(6):
        chain = chain[8:] + fresh(8)
        texts.append(" ".join(chain))
    for changes in range(12):
        other = fresh(180)
        texts += [" ".join(other), varied(rnd, other, changes)]
    passage = fresh(100)
    texts += [" ".join(passage + fresh(60)) for _ in range(30)]
    texts += ["one two", "One  two", "one", "two one", "", None, " \n", texts[0], texts[0].upper(), texts[7]]
    rnd.shuffle(texts)
    pairs = list(enumerate(texts))
    want, sizes = plain_groups(pairs, size, 80)
    got = minhash_dedup.near_groups(table([(i, t, None, None) for i, t in pairs]), size=size).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == sizes[r.doc_id] and r.kept == (want[r.doc_id] == r.doc_id) for r in got)


def test_near_groups_of_hard_rows(hard, empty):
    pairs = [(r.doc_id, r.text) for r in hard.collect()]
    want, _ = plain_groups([p for p in pairs if p[0] is not None], 5, 80)
    got = minhash_dedup.near_groups(hard).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(i) for i, _ in pairs)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    kept = minhash_dedup.drop_near(hard)
    assert kept.columns == hard.columns
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id is not None}) == sorted(i for i, c in want.items() if i == c)
    assert minhash_dedup.near_groups(empty).count() == 0 and minhash_dedup.drop_near(empty).count() == 0


def test_members_of_a_crowded_bucket_meet_by_signature(table, monkeypatch):
    """Bands of one row put hundreds of unlike texts into a bucket of many blocks; only texts of pairs that survive are read again."""
    rnd = random.Random(9)
    fresh = lambda n: [f"w{rnd.randint(0, 10**6)}" for _ in range(n)]
    passage = fresh(80)
    texts = [" ".join(passage + fresh(120)) for _ in range(300)]
    texts += [varied(rnd, texts[i].split(), 2) for i in range(0, 300, 30)]
    rnd.shuffle(texts)
    pairs = list(enumerate(texts))
    seen = {}

    def counting(df, label):
        seen[label] = made = shared.stored(df, label)
        return made

    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    monkeypatch.setattr(minhash_dedup, "stored", counting)
    got = minhash_dedup.near_groups(table([(i, t, None, None) for i, t in pairs]), bands=96, rows=1).collect()
    want, _ = plain_groups(pairs, 5, 80)
    assert {r.doc_id: r.component_id for r in got} == want
    inside = seen["near-inside"].groupBy("bucket").agg({"n": "max"}).selectExpr("max(`max(n)`)").first()[0]
    assert inside > 64 and seen["near-known"].count() <= 40


def test_pruning_bound_is_the_posterior_tail():
    bounds = minhash_dedup.least_matches(0.8, 1e-3, 32, 64)
    rng = np.random.default_rng(1)
    similarity = rng.random(400_000)
    matches = rng.binomial(32, similarity)
    at = lambda m: (similarity[matches == m] >= 0.8).mean()
    assert at(bounds[32]) >= 1e-3 * 0.5 and (bounds[32] == 0 or at(bounds[32] - 1) < 3e-3)


def test_components_of_a_path_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 300)] + [(7, 7)]
    got = dict(rows(components.components(spark.createDataFrame(links, "a long, b long")), "node", "component"))
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in (5, *range(200, 300))} == {5}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(spark, x, ids=None):
    pairs = [(int(i), [float(v) for v in row] if row is not None else None, 1) for i, row in zip(ids if ids is not None else range(len(x)), x, strict=True)]
    return spark.createDataFrame(pairs, "vec_id long, embedding array<float>, rank int")


def exact(x, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        out[q] = [(int(i), d[i]) for i in sorted((i for i in range(len(x)) if i != q), key=lambda i: (d[i], i))[:k]]
    return out


def test_neighbours_reach_the_recall_and_scores_are_exact(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(2500, 24)), rng.normal(size=(1500, 24)) * 0.1 + 3, np.tile(rng.normal(size=24), (600, 1))]).astype(np.float32).astype(float)
    df = vectors(spark, x)
    found = neighbours.search(df, df.where("vec_id % 50 = 0"))
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = exact(x, [i for i in range(len(x)) if i % 50 == 0])
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / (10 * len(want))
    assert hits >= 0.9
    for q, near in got.items():
        assert len(near) == 10 and near == sorted(near, key=lambda p: (p[1], p[0]))
        assert all(abs(s - np.sqrt(((x[i] - x[q]) ** 2).sum())) < 1e-12 for i, s in near)
    assert "CartesianProduct" not in plan(found) and "NestedLoop" not in plan(found)


def test_neighbours_go_on_to_parts_that_complete_a_query(spark):
    """1,100 rows, nearly all copies of one vector: two parts of seven or eight different vectors, one of them searched."""
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(15, 8)), np.tile(rng.normal(size=8), (1085, 1))])
    df = vectors(spark, x)
    found = neighbours.search(df, df.where("vec_id < 15"), recall=0.0).groupBy("query_id").count().collect()
    assert len(found) == 15 and all(r["count"] == 10 for r in found)


def test_neighbours_of_hard_rows(spark):
    x = [[1, 0], [0, 1], [1, 0], None, [0, 0], [float("nan"), 1], [float("inf"), 1], [2, 2], [1, 2, 3]]
    df = vectors(spark, x).unionByName(vectors(spark, [x[0]], [0])).unionByName(spark.sql("SELECT 20L AS vec_id, array(1F, NULL) AS embedding, 1 AS rank"))
    got = rows(neighbours.search(df, df), "query_id", "rank", "vec_id")
    assert [g for g in got if g[0] == 0] == [(0, 1, 2), (0, 2, 1), (0, 3, 7)]
    assert {g[0] for g in got} == {0, 1, 2, 7} and len(got) == 12
    assert neighbours.search(df.where("false"), df.where("false")).count() == 0


def test_each_stage_follows_its_plain_version(spark, hard, tmp_path):
    hard.write.parquet(f"{tmp_path}/documents.parquet")
    docs, columns = hard, hard.columns
    learned = language_id.profiles(docs)
    names = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs.drop("score"), learned).collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        path = f"{tmp_path}/{name}".replace(" ", "-")
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == columns
        ids = [r.doc_id for r in docs.collect()]
        if name == "language ID":
            keep = [r.doc_id for r in before if names[r.doc_id][0] != "und" and names[r.doc_id][1] >= corpus_pipeline.LANGUAGE_AT_LEAST]
            assert sorted(ids, key=repr) == sorted(keep, key=repr)
        elif name == "exact dedup":
            assert len(ids) == len({" ".join(r.text.split()) for r in before}) == len(set(ids))
        elif name == "MinHash near-dedup":
            want, _ = plain_groups([(r.doc_id, r.text) for r in before if r.doc_id is not None], 5, 80)
            assert sorted(i for i in ids if i is not None) == sorted(i for i, c in want.items() if i == c)
        elif name == "mixing sources":
            copies = mixing.mix(spark.createDataFrame(before, hard.schema)).selectExpr("sum(copies)").first()[0]
            assert len(ids) == copies
        else:
            assert docs.where("NOT same_text").count() == 0 and set(ids) == {r.doc_id for r in before}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()
