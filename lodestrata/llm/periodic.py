"""Runs of repeated words: maximal periodic stretches by uniting suffix classes in the order of falling common prefixes."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.fill_middle import runs_of_rows
from lodestrata.llm.shared import WORD, ship, whole
from lodestrata.llm.words import chained

#: Positions in a bucket of an ordered set before it is cut in two.
BUCKET = 1024
RUNS = "array<struct<start:long,length:long,period:long>>"
_U = np.uint64


class Numbers(dict):
    """A number for each word met, in the order of meeting."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class Places:
    """An ordered set of positions, in buckets, so that a position enters at the price of a bucket however many there are."""

    __slots__ = ("buckets", "firsts", "size")

    def __init__(self, only: int):
        self.buckets, self.firsts, self.size = [[only]], [only], 1

    def __iter__(self) -> Iterator[int]:
        return chain.from_iterable(self.buckets)

    def add(self, x: int) -> tuple[int, int]:
        """Puts a position in; returns its neighbours below and above, -1 where there is none."""
        k = max(bisect_right(self.firsts, x) - 1, 0)
        bucket = self.buckets[k]
        at = bisect_left(bucket, x)
        below = bucket[at - 1] if at else self.buckets[k - 1][-1] if k else -1
        above = bucket[at] if at < len(bucket) else self.buckets[k + 1][0] if k + 1 < len(self.buckets) else -1
        bucket.insert(at, x)
        self.firsts[k] = bucket[0]
        self.size += 1
        if len(bucket) > BUCKET:
            half = len(bucket) // 2
            self.buckets[k : k + 1] = [bucket[:half], bucket[half:]]
            self.firsts.insert(k + 1, bucket[half])
        return below, above


def suffix_order(code: np.ndarray, doc: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Positions in the order of (document, words from there to the document's end), by doubling.

    ``stop``: end of each position's document. Only positions that still share their first words with another are sorted on.
    """
    n = len(code)
    order = np.lexsort((code, doc))
    fresh = np.r_[True, (np.diff(code[order]) != 0) | (np.diff(doc[order]) != 0)]
    slot = np.arange(n)
    lead = np.maximum.accumulate(np.where(fresh, slot, 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = lead
    shared = ~fresh | ~np.r_[fresh[1:], True]
    left, h = order[shared], 1
    while len(left):
        ahead = left + h
        second = np.where(ahead < stop[left], rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[left] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        left, key = left[by], key[by]
        old = rank[left]
        # Slots of an old class are its rank and those after it.
        new_class = np.r_[True, np.diff(old) != 0]
        at = np.arange(len(left))
        own = old + at - np.maximum.accumulate(np.where(new_class, at, 0))
        order[own] = left
        fresh = np.r_[True, np.diff(key) != 0]
        rank[left] = own[np.maximum.accumulate(np.where(fresh, at, 0))]
        left, h = left[~fresh | ~np.r_[fresh[1:], True]], h * 2
    return order


def shared_prefixes(code: np.ndarray, doc: np.ndarray, stop: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each wanted position (in order) the one before it in the order of suffixes, and how many words both share; -1 and 0 across documents.

    The words shared with the one before fall by at most one from a position to the next, so all take time in proportion to the text.
    """
    order = suffix_order(code, doc, stop)
    before = np.empty(len(code), dtype=np.int64)
    before[order] = np.r_[-1, order[:-1]]
    other = before[wanted]
    other = np.where((other >= 0) & (doc[other] == doc[wanted]), other, -1)
    words, size, last, out = code.tolist(), 0, -1, []
    for i, j, end in zip(wanted.tolist(), other.tolist(), stop[wanted].tolist(), strict=True):
        if j < 0:
            size = 0
        else:
            size = max(size - (i - last), 0)
            most = end - max(i, j)
            while size < most and words[i + size] == words[j + size]:
                size += 1
        last = i
        out.append(size)
    return other, np.array(out, dtype=np.int64)


def united(edges: Iterator[tuple[int, int, int]], word: list[int], start: list[int], min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """Runs as (position, length, period) from edges (words shared, position, position) in the order of falling words shared.

    Classes of suffixes are united as the edges come; a class holds its positions in order. When two classes meet at ``size`` shared words, the
    smaller one's positions enter the larger, and positions p and p + d of different classes that become neighbours share exactly ``size`` words. So
    the words from p on have period d for size + d words and no further, and d is the least such period, as a lesser one would have put a position
    between them before. With the word before p not continuing the period this is a run; every run is found so at its own first word.
    """
    parent: dict[int, int] = {}
    places: dict[int, Places] = {}
    found = []

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def seed(p: int, q: int, size: int) -> None:
        d = q - p
        if size >= (min_exponent - 1) * d and size + d >= min_length and (p == start[p] or word[p - 1] != word[q - 1]):
            found.append((p, size + d, d))

    for size, a, b in edges:
        a, b = root(a), root(b)
        if a == b:
            continue
        large, small = places.pop(a, None) or Places(a), places.pop(b, None) or Places(b)
        if large.size < small.size:
            a, b, large, small = b, a, small, large
        parent[b] = a
        places[a] = large
        entering = list(small)
        last = -1
        for k, x in enumerate(entering):
            below, above = large.add(x)
            # Neighbours that were of the same class before have met earlier, or another position will come between.
            if below >= 0 and below != last:
                seed(below, x, size)
            if above >= 0 and (k + 1 == len(entering) or entering[k + 1] > above):
                seed(x, above, size)
            last = x
    return found


def runs_in(texts: list[list[bytes]], min_length: int, min_exponent: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words as (start, length, period), by start and then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    # A run of period d shares so many words with itself moved by d; the least of these is what any run needs.
    least = min(max(min_length - d, (min_exponent - 1) * d) for d in range(1, min_length + 1))
    numbers = Numbers()
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    code = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=lengths.sum())

    def laid(chosen: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document, first position and end of the document for each position; which positions' next words come again in the document."""
        doc = np.repeat(chosen, lengths[chosen])
        ends = np.cumsum(lengths[chosen])
        stop = np.repeat(ends, lengths[chosen])
        begin = np.repeat(ends - lengths[chosen], lengths[chosen])
        places = np.flatnonzero(np.arange(len(code)) + least <= stop)
        key = chained([doc[places].view(_U), *(code[places + k].view(_U) for k in range(least))])
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        return doc, begin, stop, places[times[inverse] > 1]

    doc, _, _, again = laid(np.arange(len(texts)), code)
    chosen = np.unique(doc[again])
    if not len(chosen):
        return out
    code = code[np.isin(doc, chosen)]
    doc, begin, stop, again = laid(chosen, code)
    other, size = shared_prefixes(code, doc, stop, again)
    keep = np.flatnonzero(size >= least)
    keep = keep[np.argsort(-size[keep], kind="stable")]
    edges = zip(size[keep].tolist(), again[keep].tolist(), other[keep].tolist(), strict=True)
    for p, length, period in united(edges, code.tolist(), begin.tolist(), min_length, min_exponent):
        out[doc[p]].append((p - int(begin[p]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    first, length, period = np.array(runs, dtype=np.int64).T
    np.add.at(steps, first + period, 1)
    np.add.at(steps, first + length, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """Runs of each whole text's words: ``id_col``, n_words, runs (start, length, period; by start, then period), collapsed.

    A run is a stretch of words with least period q (words q apart are the same), of at least ``min_length`` words and ``min_exponent`` (2 or more)
    periods, that no neighbouring word extends. ``collapsed`` is the text's words joined by one space, without those a run holds after its first q.
    Words are parted by ASCII white space and compared byte by byte.

    Each task sorts the suffixes of the texts of a portion of its batch, by numpy, and unites their classes; texts in which no words come again are done before. Memory
    and time grow with the portion, or with one text if it is longer, n log n in its words; a text of any length is looked at whole.

    Null and empty texts have no words, no run and an empty collapsed text; so have texts of white space. Rows that repeat an id or text each give a
    row; null ids stay null. An empty table gives an empty result. Other columns are not read, whatever their names.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), whole(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column("text").cast(pa.binary())
            for part in runs_of_rows(pa.compute.binary_length(bodies).to_numpy(zero_copy_only=False)):
                size = part.stop - part.start
                words = [body.split() for body in bodies.slice(part.start, size).to_pylist()]
                runs = runs_in(words, min_length, min_exponent)
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column("id").slice(part.start, size),
                    "n_words": pa.array(list(map(len, words)), pa.int64()),
                    "runs": pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs], run_type),
                    "collapsed": pa.array(list(map(collapsed, words, runs)), pa.binary()).cast(pa.string()),
                })

    return rows.mapInArrow(found, f"id {kind}, n_words long, runs {RUNS}, collapsed string").withColumnRenamed("id", id_col)


def strongest(runs: str | Column = "runs") -> Column:
    """The run with the greatest length over period, compared exactly; the first of equals. Null where there is none."""
    column = F.col(runs) if isinstance(runs, str) else runs
    return F.aggregate(column, F.get(column, F.lit(0)), lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def repeated_tail(id_col: str = "doc_id", text: str = "text") -> Column:
    """Texts with a periodic tail for one id in ten: with h = crc32 of the id, g = h / 10 and n words, those from a = g % n on
    repeat the first p = 1 + (n - a) / (3 + g % 8) of them. Their words are then joined by one space; other texts stay as they are."""
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    g = F.floor(h / 10)

    def tail(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int")))), " ")

    words = F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0))
    # The list of words as a variable, so that it is made once a row.
    made = F.get(F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, tail(ws)).otherwise(F.lit(""))), F.lit(0))
    return F.when(h % 10 == 0, made).otherwise(whole(text))
