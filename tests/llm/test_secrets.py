"""Secret scans against regular expressions, counters and windows in plain Python."""

import hashlib
import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan
from lodestrata.llm import queries, secrets

ROOT_SF = "/root/testdata/sf0.001"
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def plain(text, classes=secrets.CLASSES, allowed=secrets.ALLOWED):
    text = text or ""
    base = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    added = []
    for rank, c in enumerate(classes, 3):
        for m in re.finditer(f"[{c.characters}]+", text):
            if len(m[0]) < c.window or any(re.search(a, m[0]) for a in allowed):
                continue
            high = []
            for i in range(len(m[0]) - c.window + 1):
                counts = Counter(m[0][i : i + c.window]).values()
                if -sum(n / c.window * math.log2(n / c.window) for n in counts) < c.bits:
                    continue
                lo, hi = m.start() + i, m.start() + i + c.window
                if high and lo <= high[-1][1]:
                    high[-1][1] = hi
                else:
                    high.append([lo, hi])
            added += [(lo, rank, hi, c.kind) for lo, hi in high if not any(b[0] <= lo and hi <= b[2] for b in base)]
    return sorted(base), sorted(added)


def random_text(rng):
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    made = []
    for _ in range(rng.randint(0, 12)):
        kind, n = rng.randrange(11), rng.randint(10, 90)
        made.append([
            lambda: "".join(rng.choice(letters + "+/") for _ in range(n)), lambda: "".join(rng.choice("0123456789abcdef") for _ in range(n)),
            lambda: "".join(rng.choice("0123456789ABCDEF") for _ in range(n)), lambda: rng.choice(["Password", "api_key", "APIKEY", "token", "ſecret", "secret"]) + rng.choice([" = ", ":", '": "', "=", " "]) + letters[:n % 9],
            lambda: "AKIA" + "".join(rng.choice(letters[:26]) for _ in range(n % 24)), lambda: "é漢\U0001f600 ordinary words of text", lambda: "a-long-slug-of-lower-case-words-2024-05",
            lambda: "123e4567-e89b-42d3-a456-426614174000", lambda: "0" * n, lambda: "aA1" * n, lambda: "example" + "".join(rng.choice(letters) for _ in range(n)),
        ][kind]())
    return rng.choice([" ", "\n", "; "]).join(made)


def test_spans_equal_plain_ones(spark):
    rng = random.Random(11)
    texts = [None, "", "  ", *(random_text(rng) for _ in range(250)), " ".join(random_text(rng) for _ in range(150)), "".join(rng.choice("abcXYZ0189+/") for _ in range(3000)), "token=abcdef " * 700]
    docs = spark.createDataFrame([(None if i == 5 else i, t, 1, "clash", "clash") for i, t in enumerate(texts)], "doc_id long, text string, id int, body string, base string")
    rows = {r["doc_id"]: r for r in secrets.scan_secrets(docs).collect()}
    assert len(rows) == len(texts)
    kinds = Counter()
    for i, text in enumerate(texts):
        r = rows[None if i == 5 else i]
        base, added = plain(text)
        assert ([tuple(x) for x in r["base"]], [tuple(x) for x in r["added"]]) == (base, added), text
        kinds.update(x[3] for x in base + added)
    assert set(kinds) == {"assign", "access", "hex", "entropy64", "entropy16"}
    nothing = secrets.scan_secrets(docs.limit(0))
    assert nothing.columns == ["doc_id", "base", "added"] and nothing.count() == 0


def test_own_classes_and_lists(spark):
    classes = (secrets.CharacterClass("digits", "0-9", 8, 2.5),)
    docs = spark.createDataFrame([(1, "call 1234567890 or 1111111111"), (2, "98765432")], "doc_id long, text string")
    found = {r["doc_id"]: [(x["start"], x["stop"]) for x in r["added"]] for r in secrets.scan_secrets(docs, classes=classes, allowed=["^98"]).collect()}
    assert found == {1: [(5, 15)], 2: []}
    assert all(r["added"] == [] for r in secrets.scan_secrets(docs, classes=()).collect())


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.integers(-9, 9), max_size=900), max_size=3))
def test_running_sums(spark, lists):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<bigint>")
    for i, x, sums in df.select("i", "x", secrets.running(F.col("x"))).collect():
        total, want = 0, []
        for v in x:
            total += v
            want.append(total)
        assert sums == want


def test_clean_prose_has_no_spans(spark):
    texts = ["A plain sentence about rivers, 2024-05-06, order 12345678901234567890123456.", "see https://example.org/some/long/path/of/words/in-a-row.html", "Donaudampfschifffahrtsgesellschaftskapitän"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(not r["base"] and not r["added"] for r in secrets.scan_secrets(docs).where("doc_id <> 0").collect())
    assert [x["kind"] for x in secrets.scan_secrets(docs).where("doc_id = 0").first()["base"]] == ["hex"]


def test_op12_query_equals_plain_spans_without_python(spark):
    docs = queries.documents(spark, ROOT_SF).select("doc_id", "text").collect()
    made = queries.QUERIES["op12_secrets"](spark, ROOT_SF)
    assert not re.search("Python|Pandas|Arrow|Exchange", plan(made))
    rows = {r["doc_id"]: r for r in made.collect()}
    assert len(rows) == len(docs)
    joined = lambda spans: ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
    for doc_id, text in docs:
        base, added = plain(text)
        counts = Counter(x[3] for x in base)
        r = rows[doc_id]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (counts["assign"], counts["access"], counts["hex"])
        assert r["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest()
        assert r["spans"] == joined(sorted(base + added))
