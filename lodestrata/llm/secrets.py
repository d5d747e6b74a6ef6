"""Secrets in texts: fixed patterns, and windows of high entropy over candidate strings (DataFrame functions only)."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.shared import whole

#: The patterns that are always reported, with the least length of a match (of group 2 for the first).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Counts of characters lie in longs, so many to a long; a window must fit one count.
BITS, COUNTS = 5, 12
FIRST, CODES = ord("+"), ord("z") - ord("+") + 1
SCALE = 1 << 20
#: Numbers whose running sums are taken together; blocks keep the work near linear, as an array is copied when it grows.
BLOCK = 256


@dataclass(frozen=True)
class CharacterClass:
    """Strings of some characters, all between + and z, in which each window with ``bits`` of entropy per character is reported."""

    kind: str
    characters: str
    window: int
    bits: float

    def most(self) -> int:
        """The largest sum of c log2 c over a window's counts (times SCALE) that still has the entropy wanted."""
        return math.floor(SCALE * self.window * (math.log2(self.window) - self.bits))


#: Random characters of 64 kinds have 4.2 bits in a window of 24, joined words at most 3.8; random hexadecimal digits have 3.5.
CLASSES = (CharacterClass("entropy64", "A-Za-z0-9+/_=-", 24, 4.0), CharacterClass("entropy16", "A-Fa-f0-9", 24, 3.0))
#: Candidates that are no secrets: numbers, words of letters alone, words and short numbers joined by signs, UUIDs, placeholders.
ALLOWED = (
    r"^[0-9]+$",
    r"^[A-Za-z]+$",
    r"^[-_/=+]*(?:[A-Za-z][a-z]*|[A-Z]+|[0-9]{1,4})(?:[-_/=+]+(?:[A-Za-z][a-z]*|[A-Z]+|[0-9]{1,4}))*[-_/=+]*$",
    r"^[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$",
    r"(?i:example|sample|dummy|placeholder|changeme)",
)
SPAN = "struct<start:long,rank:int,stop:long,kind:string>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(numbers: Column) -> Column:
    """Sums of an array of longs up to each place."""

    def sums(block: Column, start: Column) -> Column:
        begin = F.struct(start.alias("total"), F.expr("CAST(array() AS array<long>)").alias("seen"))

        def add(acc: Column, x: Column) -> Column:
            return F.struct((acc["total"] + x).alias("total"), F.concat(acc["seen"], F.array(acc["total"] + x)).alias("seen"))

        return F.aggregate(block, begin, add, lambda acc: acc["seen"])

    def joined(values: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")), lambda b: F.slice(values, b * BLOCK + 1, BLOCK))
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda x, y: x + y))
        return F.flatten(F.zip_with(blocks, bound(totals, lambda t: F.zip_with(sums(t, F.lit(0).cast("long")), t, lambda x, y: x - y)), sums))

    return bound(numbers, lambda v: F.when(F.size(v) > 0, joined(v)).otherwise(v))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that don't overlap, as an array of (start, found), in code points. The pattern must not match the empty string.

    What stands between the matches tells where they are.
    """

    def placed(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        sizes = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda gap, x: (F.length(gap) + F.length(x)).cast("long"))
        return F.zip_with(running(sizes), found, lambda stop, x: F.struct((stop - F.length(x)).alias("start"), x.alias("found")))

    none = F.expr("CAST(array() AS array<struct<start:long,found:string>>)")
    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(none))


def spans_of(found: Column, kind: str, rank: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), (m["start"] + F.length(m["found"])).alias("stop"), F.lit(kind).alias("kind")))



def high_windows(found: str, of: CharacterClass) -> str:
    """SQL: the windows of a string ``found`` whose entropy is high enough, united where they overlap, as an array of (lo, hi) from 0.

    A window slides by one character: one count rises, one falls, and the sum of c log2 c over the counts changes by two entries of a
    table. The sums are whole numbers, so no rounding adds up. Counts are packed in a few longs.
    """
    w = of.window
    if w >= 1 << BITS:
        raise ValueError(f"a window has at most {(1 << BITS) - 1} characters")
    f = [round(SCALE * c * math.log2(c)) if c else 0 for c in range(w + 1)]
    steps = f"array({', '.join(f'{b - a}L' for a, b in zip(f, f[1:], strict=False))})"

    def count(x: str) -> str:
        return f"CAST(shiftright(acc.counts[{x} DIV {COUNTS}], CAST({BITS} * ({x} % {COUNTS}) AS INT)) & {(1 << BITS) - 1} AS INT)"

    def one(x: str) -> str:
        return f"IF(k = {x} DIV {COUNTS}, shiftleft(1L, CAST({BITS} * ({x} % {COUNTS}) AS INT)), 0L)"

    moved = f"IF(x.enter = x.leave, 0L, {steps}[{count('x.enter')}] - IF(x.leave < 0, 0L, {steps}[{count('x.leave')} - 1]))"
    counted = f"IF(x.enter = x.leave, acc.counts, transform(acc.counts, (n, k) -> n + {one('x.enter')} - IF(x.leave < 0, 0L, {one('x.leave')})))"
    state = "struct(new.counts AS counts, new.total AS total, {lo} AS lo, {hi} AS hi, {done} AS done)"
    ended = "concat(acc.done, array(struct(acc.lo AS lo, acc.hi AS hi)))"
    return f"""
    get(transform(array(transform(split({found}, ''), c -> ascii(c) - {FIRST})), codes -> aggregate(
      transform(codes, (c, i) -> struct(c AS enter, IF(i < {w}, -1, get(codes, i - {w})) AS leave, i AS i)),
      struct(array_repeat(0L, {-(-CODES // COUNTS)}) AS counts, 0L AS total, -1 AS lo, -1 AS hi, CAST(array() AS array<struct<lo:int,hi:int>>) AS done),
      (acc, x) -> get(transform(array(struct({counted} AS counts, acc.total + {moved} AS total)), new -> CASE
        WHEN x.i < {w - 1} OR new.total > {of.most()} THEN {state.format(lo='acc.lo', hi='acc.hi', done='acc.done')}
        WHEN acc.hi >= x.i - {w - 1} THEN {state.format(lo='acc.lo', hi='x.i + 1', done='acc.done')}
        ELSE {state.format(lo=f'x.i - {w - 1}', hi='x.i + 1', done=f'IF(acc.hi < 0, acc.done, {ended})')} END), 0),
      acc -> IF(acc.hi < 0, acc.done, {ended}))), 0)"""


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", classes: Sequence[CharacterClass] = CLASSES, allowed: Sequence[str] = ALLOWED
) -> DataFrame:
    """Where each whole text may hold secrets: ``id_col``, base and added, both arrays of (start, rank, stop, kind) in this order.

    Places are code points from 0, the end exclusive. ``base``: matches of the fixed patterns, assign (a name, a sign and a value of 6 characters),
    access (an access key) and hex (24 digits), leftmost and non-overlapping for each kind, the whole match being the span; matches that are too short
    are dropped. ``added``: in strings of a character class as long as its window, the stretches whose every window of that many characters
    has the entropy asked for, unless the string fits an allow-list pattern or the stretch lies inside a base span. ``rank`` is the place of the kind:
    assign, access, hex, then the classes.

    All of it is expressions over one row, without a shuffle. Work grows with the text (a match or window a step); a text of any length is searched whole.

    Null and empty texts have no spans. Rows that repeat an id or text each give a row; null ids stay null. An empty table gives an empty result. Other
    columns are not read, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("id"), whole(text).alias("body"))
    body = F.col("body")
    long_enough = {
        "assign": lambda m: F.length(F.regexp_extract(m["found"], ASSIGN, 2)) >= LEAST["assign"],
        "access": lambda m: F.length(m["found"]) >= LEAST["access"],
        "hex": lambda m: F.length(m["found"]) >= LEAST["hex"],
    }
    patterns = {"assign": ASSIGN, "access": ACCESS.replace("+", f"{{{LEAST['access'] - 4},}}"), "hex": HEX.replace("+", f"{{{LEAST['hex']},}}")}
    base = [spans_of(F.filter(matches(body, patterns[k]), long_enough[k]), k, i) for i, k in enumerate(LEAST)]
    rows = rows.withColumn("base", F.array_sort(F.concat(*base)))
    added = []
    for i, of in enumerate(classes):
        strings = matches(body, f"[{of.characters}]{{{of.window},}}")
        secret = F.filter(strings, lambda m: ~F.exists(F.array(*map(F.lit, allowed)), lambda a: F.rlike(m["found"], a))) if allowed else strings
        rows = rows.withColumn(f"strings{i}", secret)
        added.append(f"""flatten(transform(strings{i}, m -> transform({high_windows('m.found', of)},
          s -> named_struct('start', m.start + s.lo, 'rank', {len(LEAST) + i}, 'stop', m.start + s.hi, 'kind', '{of.kind}'))))""")
    rows = rows.withColumn("high", F.expr(f"concat({', '.join(added)})") if added else F.expr(f"CAST(array() AS array<{SPAN}>)"))
    outside = F.filter("high", lambda s: ~F.exists("base", lambda b: (b["start"] <= s["start"]) & (s["stop"] <= b["stop"])))
    return rows.select(F.col("id").alias(id_col), "base", F.array_sort(outside).alias("added"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:stop, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def oracle_sql() -> str:
    """The query over spans in SQL that has lists, a list's entropy and regular expressions."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    base = [("assign", ASSIGN, f"length(regexp_extract(found, {quoted(ASSIGN)}, 2)) >= {LEAST['assign']}"), ("access", ACCESS, f"length(found) >= {LEAST['access']}"), ("hex", HEX, f"length(found) >= {LEAST['hex']}")]
    allowed = " OR ".join(f"regexp_matches(found, {quoted(a)})" for a in ALLOWED)
    entropy = [(c.kind, f"[{c.characters}]{{{c.window},}}", f"NOT ({allowed})") for c in CLASSES]
    placed = """SELECT doc_id, i, hits[i] AS found, list_sum([length(x) for x in gaps[1:i]]) + coalesce(list_sum([length(x) for x in hits[1:i - 1]]), 0) AS start
      FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(body, {p}) AS hits, string_split_regex(body, {p}) AS gaps FROM d))"""
    spans = [f"SELECT doc_id, '{kind}' AS kind, {rank} AS rank, start, start + length(found) AS stop FROM ({placed.format(p=quoted(pattern))}) WHERE {keep}" for rank, (kind, pattern, keep) in enumerate(base)]
    high = []
    for rank, ((kind, pattern, keep), c) in enumerate(zip(entropy, CLASSES, strict=True), len(base)):
        windows = f"""SELECT doc_id, i, start + moved AS start FROM (SELECT *, string_split(found, '') AS chars, unnest(range(0, length(found) - {c.window - 1})) AS moved FROM ({placed.format(p=quoted(pattern))}) WHERE {keep})
          WHERE list_entropy(chars[moved + 1:moved + {c.window}]) >= {c.bits}"""
        islands = f"SELECT *, count(*) FILTER (WHERE step) OVER (PARTITION BY doc_id, i ORDER BY start) AS island FROM (SELECT *, start - lag(start) OVER (PARTITION BY doc_id, i ORDER BY start) > {c.window} AS step FROM ({windows}))"
        high.append(f"SELECT doc_id, '{kind}' AS kind, {rank} AS rank, min(start) AS start, max(start) + {c.window} AS stop FROM ({islands}) GROUP BY doc_id, i, island")
    joined = lambda where: f"coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank){where}, '')"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in LEAST)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
base AS ({' UNION ALL '.join(spans)}),
high AS ({' UNION ALL '.join(high)}),
added AS (SELECT * FROM high h WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = h.doc_id AND b.start <= h.start AND h.stop <= b.stop)),
found AS (SELECT *, true AS fixed FROM base UNION ALL SELECT *, false FROM added)
SELECT doc_id, {counts}, sha256({joined(' FILTER (WHERE fixed)')}) AS base_sha256, {joined(' FILTER (WHERE kind IS NOT NULL)')} AS spans
FROM d LEFT JOIN found USING (doc_id) GROUP BY doc_id
"""
