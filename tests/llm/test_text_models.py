"""Tokens, languages, quality, language model and segmentations against libraries, brute force and held-out rows."""

import math
import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from conftest import rows
from llm_tables import empty, hard, table  # noqa: F401 - fixtures
from pyspark.sql import functions as F

from lodestrata.llm import language_id, minhash_dedup, quality, segmentations, suffix_tree, token_counts
from lodestrata.llm.queries import QUERIES
from lodestrata.llm.shared import give_back

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a  b", "   a   b  ", "a\n\n\tb", "▁a▁ ▁", "日本語の 文章", "x" * 2000, " " * 100 + "a", " " * 700 + "b", "<s>hi</s> <0x0A>", "é" * 600, "\x00🎉 𝒳", "ab" * 400]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def random_texts(n):
    rnd = random.Random(3)
    return ["".join(rnd.choice("ab the▁ inénger\n\t!0") for _ in range(rnd.randint(1, 900))) for _ in range(n)]


def test_counts_equal_the_library_and_both_ways_agree():
    texts = ODD + random_texts(200)
    with open(MODEL, "rb") as file:
        merges = token_counts.PieceMerges(file.read())
    assert token_counts.count_texts([*texts, None], merges, {}) == [len(x) for x in library().encode(texts)] + [0]
    words = [w for w in " ".join(texts).split() if len(w) <= token_counts.LONG]
    assert merges.counts(words) == [merges.by_agenda(w) for w in words]


def test_counts_of_hard_rows(spark, hard, empty):
    got = hard.select("doc_id", "text", token_counts.token_count(spark, MODEL).alias("n")).collect()
    assert all(r.n == len(library().encode(r.text or "")) for r in got)
    assert empty.select(token_counts.token_count(spark, MODEL)).count() == 0


def plain_grams(text):
    counts = Counter()
    for word in re.sub(r"[\W\d_]+", " ", text.lower()).split():
        padded = f" {word} "
        counts.update(word)
        counts.update(padded[i : i + 2] for i in range(len(padded) - 1))
        counts.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return counts


def packed(gram):
    code = 0
    for c in gram:
        code = code << language_id.BITS | ord(c)
    return code


@pytest.mark.parametrize("text", ["Straße und Fluß", "a", "ÀÉÎ õü 12 x_y", "日本 語", "of the of"])
def test_grams(text):
    codes, counts = language_id.grams(text)
    assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == {packed(g): n for g, n in plain_grams(text).items()}


def test_language_by_rank_order(table, hard, empty):
    learn = table([(1, "the stone of the river and the cloud", "en", None), (2, "der stein und die straße und der fluss", "de", None), (3, "skipped", None, None)])
    learned = language_id.profiles(learn, top=40)
    ranks = defaultdict(dict)
    for r in learned.collect():
        ranks[r.lang][r.gram] = r["rank"]
    for lang, text in (("en", "the stone of the river and the cloud"), ("de", "der stein und die straße und der fluss")):
        best = sorted(plain_grams(text).items(), key=lambda x: (-x[1], packed(x[0])))[:40]
        assert ranks[lang] == {packed(g): k for k, (g, _) in enumerate(best, 1)}
    got = language_id.identify(hard, learned, top=40)
    for r in got.select("text", "lang_pred", "score").collect():
        if not r.text or not any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        own = sorted(plain_grams(r.text).items(), key=lambda x: (-x[1], packed(x[0])))[:40]
        far = {lang: sum(abs(known[packed(g)] - k) if packed(g) in known else 40 for k, (g, _) in enumerate(own, 1)) for lang, known in ranks.items()}
        assert r.lang_pred == min(sorted(far), key=far.get) and abs(r.score - (1 - min(far.values()) / (40 * len(own)))) < 1e-12
    assert set(got.columns) == {*hard.columns, "lang_pred"}
    nothing = language_id.profiles(empty)
    assert rows(language_id.identify(hard, nothing), "lang_pred") == [("und",)] * hard.count()
    assert language_id.identify(empty, learned).count() == 0


def test_quality_of_held_out_rows(spark, table, hard, empty):
    rnd = random.Random(1)
    good = lambda: " ".join(rnd.choice(["the", "stone", "of", "a", "river", "lies"]) + rnd.choice(["", "", "."]) for _ in range(40))
    bad = [lambda: good().upper(), lambda: good().replace(" ", "$$$ "), lambda: " ".join([rnd.choice("xyzvw") * 3] * 30)]
    docs = table([(i, good() if i % 4 else bad[i % 3](), None, None) for i in range(400)])
    labels = spark.range(400).selectExpr("id AS doc_id", "IF(id % 4 = 0, 0, 1) AS quality").where("doc_id % 5 <> 0")
    labels = labels.unionByName(spark.sql("SELECT NULL AS doc_id, 1 AS quality UNION ALL SELECT 3, NULL"))
    weights = quality.fit(docs, labels, "quality")
    assert np.array_equal(weights, quality.fit(docs.repartition(7), labels.repartition(3), "quality"))
    held = docs.where("doc_id % 5 = 0").select("doc_id", quality.quality(spark, weights).alias("p")).collect()
    assert all((r.p >= 0.3) == (r.doc_id % 4 != 0) for r in held)
    scores = hard.select(quality.quality(spark, weights).alias("p")).collect()
    assert len(scores) == hard.count() and all(0 <= r.p <= 1 for r in scores)
    none = quality.fit(docs, labels.where("false"), "quality")
    assert not none.any() and empty.select(quality.quality(spark, none)).count() == 0


def test_quality_equals_a_plain_leader(spark, table):
    """Weights and scores of follow-the-regularised-leader, one coordinate at a time in dicts."""
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(["Stone", "river", "of.", "THE", "cloud!"]) for _ in range(rnd.randint(0, 12))) for _ in range(60)]
    docs = table([(i, t, None, None) for i, t in enumerate(texts)])
    labels = spark.range(60).selectExpr("id AS doc_id", "CAST(id % 3 = 0 AS INT) AS quality")
    order = [r.id for r in spark.range(60).orderBy(F.xxhash64("id", F.lit("fit"))).collect()]
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    def inputs(text):
        bins = quality.features(text).tolist()
        return {**{b: c * quality.SCALE / len(bins) for b, c in Counter(bins).items()}, quality.BINS: 1.0}

    def chance(x):
        return 1 / (1 + math.exp(-sum(weight(i) * v for i, v in x.items())))

    for i in order * quality.EPOCHS:
        x = inputs(texts[i])
        error, w = chance(x) - (i % 3 == 0), {j: weight(j) for j in x}
        for j, v in x.items():
            g = error * v
            z[j] += g - (math.sqrt(n[j] + g * g) - math.sqrt(n[j])) / quality.ALPHA * w[j]
            n[j] += g * g
    got = quality.fit(docs, labels, "quality")
    assert set(np.flatnonzero(got)) == {j for j in n if weight(j)} and all(abs(got[j] - weight(j)) < 1e-5 for j in n)
    for r in docs.select("doc_id", quality.quality(spark, got).alias("p")).collect():
        assert abs(r.p - chance(inputs(texts[r.doc_id]))) < 1e-5


def plain_tree_score(train, texts):
    """The same suffix tree with dicts."""
    split = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + ["</s>"]
    uni, pairs, triples = Counter(), Counter(), Counter()
    for t in train:
        tok = split(t)
        uni.update(tok)
        pairs.update(zip(["<s>", *tok], tok, strict=False))
        triples.update(zip(zip(["<s>", *tok], tok, strict=False), tok[1:], strict=False))
    total, words = sum(uni.values()), len(uni)
    p0 = lambda w: (uni[w] + 0.5) / (total + 0.5 * (words + 1))
    d = suffix_tree.DISCOUNT

    def judged(kept, number, lower):
        by = defaultdict(dict)
        for (ctx, w), n in kept.items():
            by[ctx][w] = n
        out = {}
        for ctx, seen in by.items():
            big = number(ctx)
            left = 1 - sum(n - d for n in seen.values()) / big
            gain = sum(n * math.log(((n - d) / big + left * lower(ctx, w)) / lower(ctx, w)) for w, n in seen.items())
            if gain + (big - sum(seen.values())) * math.log(left) >= suffix_tree.GAIN:
                out[ctx] = {w: (n - d) / big for w, n in seen.items()}, left
        return out

    one = judged({k: n for k, n in pairs.items() if n >= suffix_tree.PAIR_SEEN}, lambda c: len(train) if c == "<s>" else uni[c], lambda c, w: p0(w))
    p1 = lambda c, w: one[c][0].get(w, 0) + one[c][1] * p0(w) if c in one else p0(w)
    frequent = {k for k, n in pairs.items() if n >= suffix_tree.PAIR_SEEN}
    kept = {k: n for k, n in triples.items() if n >= suffix_tree.PAIR_SEEN and k[0] in frequent}
    two = judged(kept, pairs.__getitem__, lambda c, w: p1(c[1], w))
    out = []
    for t in texts:
        tok = ["<s>", *split(t)]
        score = 0.0
        for i in range(1, len(tok)):
            ctx = (tok[i - 2], tok[i - 1]) if i > 1 else None
            p = two[ctx][0].get(tok[i], 0) + two[ctx][1] * p1(tok[i - 1], tok[i]) if ctx in two else p1(tok[i - 1], tok[i])
            score += math.log10(p)
        out.append((sum(math.log10(p0(w)) for w in tok[1:]), score))
    return out, len(one), len(two)


@pytest.mark.parametrize("head,top", [(100_000, 200_000), (5, 3)])
def test_suffix_tree_equals_dicts(table, hard, monkeypatch, head, top):
    """Also with tables so small that nearly all goes through the joins."""
    monkeypatch.setattr(suffix_tree, "HEAD", head)
    monkeypatch.setattr(suffix_tree, "TOP", top)
    rnd = random.Random(2)
    train = [" ".join(rnd.choice(["the old stone", "a River runs", "of the sea", rnd.choice("pqrst")]) for _ in range(rnd.randint(0, 25))) for _ in range(150)] + [None]
    held = ["the old stone of the sea unseen words", None, "", "a river runs a river"] + [r.text for r in hard.where("length(text) < 500").collect()]
    tree = suffix_tree.fit(table([(i, t, None, None) for i, t in enumerate(train)]))
    want, n_one, n_two = plain_tree_score(train, held)
    assert n_one and n_two
    got = {r.doc_id: r for r in suffix_tree.score(table([(i, t, None, None) for i, t in enumerate(held)]), tree).collect()}
    assert len(got) == len(held)
    for i, (base, score) in enumerate(want):
        assert abs(got[i].base_score - base) < 1e-6 and abs(got[i].score - score) < 1e-6, held[i]
    assert sum(s for _, s in want[:4]) > sum(b for b, _ in want[:4])


def test_suffix_tree_retains_contexts_seen_few_times(table):
    """Two words seen three times, always before the same word, against two words never seen together."""
    rnd = random.Random(7)
    train = [" ".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(30)) + " river" + f" {w}" for w in "abcdefghijklmnopqrst"]
    train += [" ".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(30)) + " old river zinc" for _ in range(3)]
    tree = suffix_tree.fit(table([(i, t, None, None) for i, t in enumerate(train)]))
    held = ["old river zinc", "old river", "never river zinc", "never river"]
    got = {r.doc_id: r.score for r in suffix_tree.score(table([(i, t, None, None) for i, t in enumerate(held)]), tree).collect()}
    # The context predicts the word with (3 - DISCOUNT) / 3 at least; the end after it costs the same on both sides.
    assert (got[0] - got[1]) - (got[2] - got[3]) > 0.5


def deep_tree_score(train, texts, deepest):
    """The same suffix tree with dicts and contexts of up to ``deepest`` words, every one of them tested."""
    split = lambda t: ["<s>", *t.split(), "</s>"]
    uni = Counter(w for t in train for w in split(t)[1:])
    scale, d = sum(uni.values()) + 0.5 * (len(uni) + 1), suffix_tree.DISCOUNT
    kept = {}

    def p(ctx, w):
        while ctx and ctx not in kept:
            ctx = ctx[1:]
        return kept[ctx][0].get(w, 0) + kept[ctx][1] * p(ctx[1:], w) if ctx else (uni[w] + 0.5) / scale

    for size in range(1, deepest + 1):
        seen = defaultdict(Counter)
        for tok in map(split, train):
            for i in range(size, len(tok)):
                seen[tuple(tok[i - size : i])][tok[i]] += 1
        fresh = {}
        for ctx, after in seen.items():
            total, often = sum(after.values()), {w: n for w, n in after.items() if n >= suffix_tree.PAIR_SEEN}
            left = 1 - sum(n - d for n in often.values()) / total
            low = {w: p(ctx[1:], w) for w in often}
            gain = sum(n * math.log((n - d) / total / low[w] + left) for w, n in often.items())
            if often and gain + (total - sum(often.values())) * math.log(left) >= suffix_tree.GAIN:
                fresh[ctx] = {w: (n - d) / total for w, n in often.items()}, left
        kept.update(fresh)
    scores = [sum(math.log10(p(tuple(tok[max(0, i - deepest) : i]), tok[i])) for i in range(1, len(tok))) for tok in map(split, texts)]
    return scores, max(map(len, kept))


@pytest.mark.parametrize("local,reach", [(250_000, (8, 64)), (0, (8, 64)), (250_000, (1, 2)), (25, (2, 3))])
def test_suffix_tree_grows_while_contexts_gain(table, monkeypatch, local, reach):
    """The word after four words tells the first of them, and texts of one word repeated differ in length. Contexts grow inside tasks, by
    counting all tokens, or one way after the other."""
    monkeypatch.setattr(suffix_tree, "LOCAL", local)
    monkeypatch.setattr(suffix_tree, "REACH", reach)
    rnd = random.Random(3)
    train = [" ".join(f"{x} m n o {x}{x}" if rnd.random() < 0.9 else rnd.choice("pq") for x in rnd.choices("abcdef", k=12)) for _ in range(40)]
    train += [" ".join(["r"] * rnd.choice([3, 6]) + [rnd.choice("st")]) for _ in range(30)]
    held = ["a m n o aa", "z m n o aa", "m n o bb", "r r r r r r s", "r r r t p q", ""]
    held_table, train_table = (table([(i, t, None, None) for i, t in enumerate(x)]) for x in (held, train))
    for depth in (None, 3):
        tree = suffix_tree.fit(train_table, depth=depth)
        want, longest = deep_tree_score(train, held, depth or 12)
        assert tree.depth >= longest >= 3 and (depth or longest > 3)
        got = {r.doc_id: r.score for r in suffix_tree.score(held_table, tree).collect()}
        assert all(abs(got[i] - s) < 1e-6 for i, s in enumerate(want)), depth


@pytest.mark.parametrize(("kept", "room", "chunk"), [(10**6, 10**6, 4000), (2000, 10**6, 7), (2000, 3000, 50), (0, 1, 4000)])
def test_lattices_of_words_met_before_are_kept(monkeypatch, kept, room, chunk):
    """Up to a limit no lattice is made twice; what is drawn does not depend on what was met before, on the limits or on the room."""
    with open(MODEL, "rb") as file:
        pieces = segmentations.Pieces(file.read())
    texts, keys, asked = random_texts(60) + ODD, [str(i) for i in range(60 + len(ODD))], []
    want = segmentations.sampled(texts, keys, pieces, 3, 0.5, 7)
    for name, value in (("KEPT", kept), ("ROOM", room), ("CHUNK", chunk)):
        monkeypatch.setattr(segmentations, name, value)
    make = segmentations.Lattices.__init__
    monkeypatch.setattr(segmentations.Lattices, "__init__", lambda self, tokens, *a: asked.extend(tokens) or make(self, tokens, *a))
    pieces.kept.clear()
    got = [best for a in range(0, len(texts), 5) for best in segmentations.sampled(texts[a : a + 5], keys[a : a + 5], pieces, 3, 0.5, 7)]
    for one, other in zip(want, got, strict=True):
        assert [(x[0].tolist(), *x[1:]) for x in one] == [(x[0].tolist(), *x[1:]) for x in other]
    made = len(asked)
    segmentations.sampled(texts, keys, pieces, 3, 0.5, 7)
    assert (len(asked) == made) == (kept == 10**6)


def test_suffix_tree_of_large_contexts_and_packed_scores(table, monkeypatch):
    """Contexts too large for one task are tested by joins, with the same result; scoring joins no row of an n-gram."""
    rnd = random.Random(5)
    train = [" ".join(f"{x} m n {x}{x}" for x in rnd.choices("abcdef", k=8)) for _ in range(30)]
    held = ["a m n aa", "z m n bb q q q q q q", ""]
    held_table = table([(i, t, None, None) for i, t in enumerate(held)])
    want, _ = deep_tree_score(train, held, 3)
    monkeypatch.setattr(suffix_tree, "HOT", 60)
    monkeypatch.setattr(suffix_tree, "HEAD", 5)
    monkeypatch.setattr(suffix_tree, "TOP", 3)
    monkeypatch.setattr(suffix_tree, "OFTEN", 4)
    monkeypatch.setattr(suffix_tree, "MANY", 20)
    tree = suffix_tree.fit(table([(i, t, None, None) for i, t in enumerate(train)]), depth=3)
    got = {r.doc_id: r.score for r in suffix_tree.score(held_table, tree).collect()}
    assert all(abs(got[i] - s) < 1e-6 for i, s in enumerate(want))
    plan = suffix_tree._scored(held_table, tree, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "CoGroup" in plan


def test_suffix_tree_buckets_follow_hashes():
    hashes = np.sort(np.random.default_rng(2).integers(0, 1 << 63, 5000, dtype=np.uint64) << np.uint64(1))
    buckets = suffix_tree._bucket(hashes, 37)
    assert (np.diff(buckets) >= 0).all() and set(buckets.tolist()) == set(range(37))
    names, blobs = suffix_tree._split(buckets[::-1], [hashes[::-1].view(np.int64)])
    assert names.tolist() == list(range(37)) and sorted(suffix_tree._unpacked(blobs, 1)[0].tolist()) == sorted(hashes.view(np.int64).tolist())


def test_suffix_tree_deals_only_places_of_living_contexts():
    """The filter of all lengths fills up; places are told by that of the last length alone."""
    codes = suffix_tree._tokens(["a b c d a b c e", "a b x y"])
    full, last = np.full(1 << 10, ~np.uint64(0)), np.zeros(1 << 10, np.uint64)
    living = suffix_tree.pair_key(codes[2:3], codes[1:2])
    for place in (int(living.view(np.uint64)[0]) & 0xFFFF, (int(living.view(np.uint64)[0]) >> 31) & 0xFFFF):
        last[place >> 6] |= np.uint64(1 << (place & 63))
    ctx, gram, before = suffix_tree._place_entries(2, 1, SimpleNamespace(value=(full, last)))(codes)
    assert len(ctx) == 3 and (ctx == living[0]).all() and len(set(gram.tolist())) == 2
    parent, near, far = suffix_tree._level_entries(3, SimpleNamespace(value=(full, last)))(codes)
    assert (near[parent == 0] == living[0]).all() and not (parent != 0).any()


def test_suffix_tree_filter_holds_its_keys(spark):
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000)
    bits = suffix_tree._filter(spark.createDataFrame(pd.DataFrame({"key": keys[:4000]})))
    assert suffix_tree.in_filter(bits, keys[:4000]).all() and not suffix_tree.in_filter(bits, keys[4000:]).any()


def test_suffix_tree_without_rows(hard, empty):
    tree = suffix_tree.fit(empty)
    got = suffix_tree.score(hard, tree)
    assert got.count() == hard.count() and got.where("n_known <> 0 OR abs(score - base_score) > 1e-9").count() == 0
    assert suffix_tree.score(empty, suffix_tree.fit(hard)).count() == 0


def test_segmentations_follow_their_distribution():
    with open(MODEL, "rb") as file:
        pieces = segmentations.Pieces(file.read())
    weight = {pieces.names[p]: pieces.weight[i] for i, p in enumerate(pieces.piece) if p >= 0}

    def ways(s):
        if not s:
            yield (), 0.0
        for n in range(1, len(s) + 1):
            if s[:n] in weight:
                yield from (((s[:n], *rest), w + weight[s[:n]]) for rest, w in ways(s[n:]))

    both = [(a + b, 0.5 * (x + y)) for a, x in ways("▁the") for b, y in ways("▁cat")]
    total = math.log(sum(math.exp(w) for _, w in both))
    prob = {a: math.exp(w - total) for a, w in both}
    n = 4000
    first, second, weighed = Counter(), Counter(), Counter()
    for best in segmentations.sampled(["the cat"] * n, [str(i) for i in range(n)], pieces, 2, 0.5, 7):
        own = [tuple(pieces.names[i] for i in ids) for ids, *_ in best]
        assert own[0] != own[1] and best[0][2] >= best[1][2]
        assert all(abs(log - math.log(prob[o])) < 1e-9 for o, (_, log, _, _) in zip(own, best, strict=True))
        first[own[0]] += 1
        second[own[1]] += 1
        for o, (_, log, _, inside) in zip(own, best, strict=True):
            weighed[o] += math.exp(log - inside)
    for way in sorted(prob, key=prob.get)[-4:]:
        again = sum(prob[x] * prob[way] / (1 - prob[x]) for x in prob if x != way)
        assert abs(first[way] / n - prob[way]) < 0.03 and abs(second[way] / n - again) < 0.03 and abs(weighed[way] / n - prob[way]) < 0.03


def test_branches_of_many_texts_are_drawn_together(monkeypatch):
    with open(MODEL, "rb") as file:
        pieces = segmentations.Pieces(file.read())
    calls = []
    pick = segmentations.Lattices.pick
    monkeypatch.setattr(segmentations.Lattices, "pick", lambda self, *a: calls.append(1) or pick(self, *a))
    texts = [f"the cat sat on mat {i} and saw überraschungen 日本語 there" for i in range(200)]
    many = segmentations.sampled(texts, [str(i) for i in range(200)], pieces, 2, 0.5, 7)
    assert len(calls) < 100  # steps along a word, not texts
    assert all(segmentations.decoded(ids, pieces) == text for text, best in zip(texts, many, strict=True) for ids, *_ in best)
    for i in (0, 71, 199):
        alone = segmentations.sampled([texts[i]], [str(i)], pieces, 2, 0.5, 7)[0]
        assert all((a[0] == b[0]).all() and a[1:] == b[1:] for a, b in zip(alone, many[i], strict=True))


def test_workers_give_back_what_a_task_has_freed():
    def held() -> int:
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096 >> 20

    blocks = [bytearray(50_000) for _ in range(6_000)]
    kept = blocks[::1000]
    most = held()
    del blocks
    give_back()
    assert held() < most - 200 and len(kept) == 6


@pytest.mark.parametrize("module", [suffix_tree, minhash_dedup, segmentations])
def test_tasks_give_back_what_they_have_freed(spark, hard, monkeypatch, tmp_path, module):
    def marked():
        import uuid

        open(f"{tmp_path}/{uuid.uuid4().hex}", "w").close()

    monkeypatch.setattr(module, "give_back", marked)
    runs = {
        suffix_tree: lambda: suffix_tree.fit(hard, depth=2),
        minhash_dedup: lambda: minhash_dedup.near_groups(hard).collect(),
        segmentations: lambda: segmentations.encode_samples(hard, MODEL).collect(),
    }
    runs[module]()
    # The tree counts words and pairs besides coding the texts, each in two steps.
    assert len(list(tmp_path.iterdir())) >= (5 if module is suffix_tree else 1)


def test_segmentations_of_hard_rows(spark, hard, empty):
    drawn = segmentations.encode_samples(hard, MODEL, k=3)
    got = drawn.collect()
    assert all(r.same_text for r in got)
    assert len({(r.doc_id, r.sample) for r in got}) == len({(r.doc_id, r.sample, r.ids_crc32) for r in got})
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((tuple(r.ids), r.sample))
    assert all(len({ids for ids, _ in v}) == len(v) for k, v in by.items())
    assert by[60] == {((), 1)} and by[61] == {((), 1)}
    assert rows(drawn, "doc_id", "sample", "ids_crc32") == rows(segmentations.encode_samples(hard.repartition(5), MODEL, k=3), "doc_id", "sample", "ids_crc32")
    back = drawn.select("doc_id", "sample", segmentations.decode(spark, MODEL).alias("back")).join(hard.dropDuplicates(["doc_id"]), "doc_id")
    assert back.where(F.col("back") != F.coalesce("text", F.lit(""))).count() == 0
    assert segmentations.encode_samples(empty, MODEL).count() == 0


def test_op8_returns_ids_and_what_decoding_them_gives(spark, hard, tmp_path):
    hard.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op8_segmentations"](spark, str(tmp_path)).dropDuplicates(["doc_id", "sample"])
    want = hard.dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("d"), F.crc32(F.coalesce("text", F.lit(""))).alias("crc"))
    met = got.join(want, F.col("doc_id").eqNullSafe(F.col("d")))
    assert met.where("size(ids) <> n_tokens OR decoded_crc32 <> crc").count() == 0 and met.count() == got.count() > 100


def test_suffix_tree_orders_keys_by_their_places():
    rng = np.random.default_rng(5)
    # Keys that differ in their low bits only, equal ones, negative ones, and as many as take several blocks.
    for keys in (np.zeros(0, np.int64), rng.integers(-9, 9, 1000), rng.integers(-(1 << 62), 1 << 62, 40_000)):
        assert (suffix_tree._order(keys) == np.argsort(keys, kind="stable")).all()
        assert (suffix_tree._order(keys.view(np.uint64)) == np.argsort(keys.view(np.uint64), kind="stable")).all()
        for got, wanted in zip(suffix_tree._classes(keys), np.unique(keys, return_index=True, return_inverse=True), strict=True):
            assert (got == wanted).all()
        whole = suffix_tree.pair_key(keys, keys[::-1])
        assert [suffix_tree.pair_key(keys[i : i + 1], keys[::-1][i : i + 1])[0] for i in range(0, len(keys), 997)] == whole[::997].tolist()


def test_suffix_tree_joins_values_as_arrays(spark):
    rows = pd.DataFrame({"key": [-7, -8, -7, -9], "n": [3, 2, 5, 90], "value": [0.5, 1.0, 0.25, -1.0]})
    packed = suffix_tree._packed_values(spark.createDataFrame(rows), ["key", "n", "value"], 2)
    joined = suffix_tree._joined_values(packed)
    found = joined.collect()
    key, base, value = suffix_tree._unpacked([r.blob for r in found], 3)
    assert dict(zip(key.tolist(), value.view(np.float64).tolist(), strict=True)) == {-7: 0.75, -8: 1.0, -9: -1.0} and not base.any()
    assert sorted(suffix_tree._unpacked([r.n for r in found], 1)[0].tolist()) == [2, 5, 90]
    assert {r.key: r.value for r in suffix_tree._most_values(joined, 2).collect()} == {-7: 0.75, -9: -1.0}
    assert suffix_tree._most_values(joined, 0).count() == 0
    bits = suffix_tree._filter(joined)
    assert suffix_tree.in_filter(bits, np.array([-7, -8, -9])).all() and not suffix_tree.in_filter(bits, np.arange(1, 500)).any()
