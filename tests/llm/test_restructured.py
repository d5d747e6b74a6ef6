"""Fill-in-middle and periodic runs against plain versions."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrata.llm import fill_middle, periodic, queries

ROOT_SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, h0 string, id string, `__group0` int"
ODD = ["", None, "a", "é", "漢字かな", "x <P> y", "<S>", "<M", "<", ">P<", "\U0001f600 smile \u0000 nul", "word " * 3000, "<" * 50, "P>" * 9, " \t\n"]


def table(spark, texts):
    return spark.createDataFrame([(None if i == 1 else i, t, "clash", "clash", 7) for i, t in enumerate(texts)], SCHEMA)


def plain_fim(doc_id, text):
    body, s = text or "", hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(s[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(body)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if n == 0 or any(m in body for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, body
    pre, mid, suf = body[:a], body[a:b], body[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle_equals_slices(spark):
    texts = ODD + [f"text {i} of ñandú {'é' * i}" for i in range(300)] + ["same text"] * 5
    made = fill_middle.fill_in_middle(table(spark, texts))
    rows = made.withColumn("back", fill_middle.restored()).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts)
    forms = set()
    for i, text in enumerate(texts):
        doc_id = None if i == 1 else i
        r = by_id[doc_id]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain_fim(doc_id, text)
        assert r["back"] == (text or "")
        forms.add(r["form"])
    assert forms == {"plain", "psm", "spm"}


def test_fill_in_middle_of_no_rows_and_broken_outputs(spark):
    empty = fill_middle.fill_in_middle(table(spark, []))
    assert empty.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"] and empty.count() == 0
    rows = [("<P>a<S>b<M>c", "psm", "acb"), ("<S>b<P>a<M>c", "spm", "acb"), ("<S>b<P>a<M>c", "psm", None), ("<P>a<S>b", "psm", None), ("x<P>a<S>b<M>c", "psm", None),
            ("<P>a<P><S>b<M>c", "psm", None), ("<P><S><M>", "psm", ""), ("any <P>", "plain", "any <P>"), (None, "psm", None), ("a", None, None), ("a", "other", None)]
    back = spark.createDataFrame(rows, "output string, form string, want string").withColumn("back", fill_middle.restored()).collect()
    assert [r["back"] for r in back] == [r["want"] for r in back]


def test_op11_query_equals_slices(spark):
    docs = {r["doc_id"]: r["text"] for r in queries.documents(spark, ROOT_SF).select("doc_id", "text").collect()}
    rows = queries.QUERIES["op11_fill_middle"](spark, ROOT_SF).collect()
    assert len(rows) == len(docs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in rows:
        n, form, prefix, middle, out = plain_fim(r["doc_id"], docs[r["doc_id"]])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert (r["output_sha256"], r["restored_sha256"]) == (sha(out), sha(docs[r["doc_id"]] or ""))


def plain_runs(words, min_length=6, min_exponent=4):
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(min_length, min_exponent * q):
                found.setdefault((i, length), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60) | st.lists(st.sampled_from("abc"), min_size=1, max_size=6).map(lambda x: x * 9), max_size=4), st.sampled_from([(6, 4), (4, 2), (2, 2), (9, 3)]))
def test_runs_equal_all_periods(texts, limits):
    found = periodic.runs_in([[w.encode() for w in t] for t in texts], *limits)
    assert found == [plain_runs(t, *limits) for t in texts]


def test_runs_of_nested_and_long_stretches():
    rng = random.Random(5)
    inner = ["a", "b"] * 5 + ["c"]
    texts = [inner * 6, ["x"] * 6000, ["l", "m", "n"] * 900 + ["l"], [rng.choice("ab") for _ in range(3000)], [str(i) for i in range(500)] * 4, [], ["x"] * 5, ["x"] * 6]
    found = periodic.runs_in([[w.encode() for w in t] for t in texts], 6, 4)
    assert found == [plain_runs(t) if len(t) < 4000 else [(0, 6000, 1)] for t in texts]


def test_ordered_sets_cut_their_buckets():
    places, known = periodic.Places(500_000), [500_000]
    rng = random.Random(3)
    for x in rng.sample(range(1_000_000), 5000):
        if x == 500_000:
            continue
        below = max((y for y in known if y < x), default=-1)
        above = min((y for y in known if y > x), default=-1)
        assert places.add(x) == (below, above)
        known.append(x)
    assert list(places) == sorted(known) and len(places.buckets) > 1


def test_periodic_runs_of_odd_rows(spark):
    texts = [*ODD, "go " * 7, "a b " * 6 + "tail", "a\tb\na b\x0ba b a\rb"]
    rows = {r["doc_id"]: r for r in periodic.periodic_runs(table(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        runs = plain_runs(words) if len(words) < 2000 else [(0, len(words), 1)]
        r = rows[None if i == 1 else i]
        assert (r["n_words"], [tuple(x) for x in r["runs"]]) == (len(words), runs)
        assert r["collapsed"] == plain_collapsed([w.decode() for w in words], runs)
    assert periodic.periodic_runs(table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(table(spark, []), min_exponent=1)


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_op13_query_equals_all_periods(spark):
    docs = queries.documents(spark, ROOT_SF).select("doc_id", "text").collect()
    rows = {r["doc_id"]: r for r in queries.QUERIES["op13_periodic_runs"](spark, ROOT_SF).collect()}
    assert len(rows) == len(docs)
    seen = 0
    for doc_id, text in docs:
        words = [w.decode() for w in planted(doc_id, (text or "").encode().split())]
        runs = plain_runs(words)
        r = rows[doc_id]
        seen += len(runs)
        best = None
        for run in runs:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *want)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
    assert seen > 0
    types = dict(queries.QUERIES["op13_periodic_runs"](spark, ROOT_SF).dtypes)
    assert all(types[c] == "bigint" for c in ("n_runs", "start", "length", "period", "exponent_milli"))


def test_repeated_tail_of_odd_rows(spark):
    texts = ["one two\tthree  four " * 4, None, "", " "] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for doc_id, out in docs.select("doc_id", periodic.repeated_tail()).collect():
        words = (texts[doc_id] or "").split()
        want = " ".join(planted(doc_id, words)) if zlib.crc32(str(doc_id).encode()) % 10 == 0 else texts[doc_id] or ""
        assert out == want
    assert docs.select(F.max(F.length(periodic.repeated_tail()))).first()[0] > 0
