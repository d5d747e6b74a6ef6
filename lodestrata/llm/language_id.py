"""Language by rank-order profiles of character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.shared import ship
from lodestrata.llm.words import portions

NOT_LETTERS = re.compile(r"[\W\d_]+")
#: n-grams in a profile, and in what a document is compared by.
TOP = 300
#: n-grams that a task holds before it passes its counts on.
HELD = 500_000
BITS = 21  # of a code point; three of them make a number
UNKNOWN = "und"


def _tally(values: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers (below ``bound``) and how often each occurs."""
    if bound <= 8 * len(values):
        counts = np.bincount(values, minlength=bound)
        there = np.flatnonzero(counts)
        return there, counts[there]
    return np.unique(values, return_counts=True)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of one to three characters inside the words of a text, a space on either side, and their counts.

    Letters are lower case; all else counts as space. An n-gram is its code points, packed into one number.
    """
    letters = NOT_LETTERS.sub(" ", text.lower()).strip()
    if not letters:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    chars, singles = _tally(points, int(points.max()) + 1)
    place = np.zeros(int(chars[-1]) + 1, np.int64)
    place[chars] = np.arange(len(chars))
    a, n = place[points], len(chars)
    space = place[32]
    pairs, pair_counts = _tally(a[:-1] * n + a[1:], n * n)
    inner = a[1:-1] != space
    triples, triple_counts = _tally(((a[:-2] * n + a[1:-1]) * n + a[2:])[inner], n**3)
    letter = chars != 32
    codes = [
        chars[letter],
        (chars[pairs // n] << BITS) | chars[pairs % n],
        (chars[triples // (n * n)] << (2 * BITS)) | (chars[triples // n % n] << BITS) | chars[triples % n],
    ]
    return np.concatenate(codes), np.concatenate([singles[letter], pair_counts, triple_counts])


def _ranked(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, best first; ties by code."""
    if len(codes) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:top]


def profiles(docs: DataFrame, lang: str = "lang", text: str = "text", top: int = TOP) -> DataFrame:
    """The ``top`` most frequent n-grams of each language over all rows: lang, gram, rank (from 1).

    Tasks count their own rows and pass on sums, so the shuffle holds at most a task's distinct n-grams; the window keeps its
    first rows before the shuffle. Rows without language or text take no part; a table without any gives an empty result. Very
    long texts are counted whole, repeated rows each; ties go to the smaller code. Other columns are not read, whatever their names.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pd.DataFrame]:
            for name, parts in held.items():
                codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                sums = np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pd.DataFrame({"lang": name, "gram": codes, "n": sums})

        for batch in batches:
            for name, rows in batch.groupby("lang")["text"]:
                texts = rows.tolist()
                for part in portions(texts):
                    found = grams(" ".join(texts[part]))
                    held.setdefault(name, []).append(found)
                    size += len(found[0])
            if size > HELD:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    ship(docs.sparkSession)
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sums = rows.mapInPandas(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return sums.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "gram", "rank")


def language(learned: DataFrame, text: str = "text", top: int = TOP) -> Column:
    """Language and score of a text, as a struct of lang_pred and score.

    The ``top`` most frequent n-grams of a document are compared with each profile by the distance between their ranks; one
    that a profile lacks counts ``top``. The nearest language is predicted, the first by code point where several are. The
    score is one less the mean distance over ``top``. Texts that are null or without a letter, and all texts if nothing was
    learned, get ``und`` and 0.

    Very long texts are counted whole; repeated rows get equal results; an empty table gives an empty one. What comes to the
    driver is ``top`` n-grams for each language, of which there should be few.
    """
    ship(learned.sparkSession)
    table = learned.toPandas()
    names = sorted(table["lang"].unique())
    known = np.unique(table["gram"].to_numpy(np.int64))
    ranks = np.full((len(names), len(known) + 1), -1, np.int64)
    for i, name in enumerate(names):
        own = table[table["lang"] == name]
        ranks[i, np.searchsorted(known, own["gram"].to_numpy(np.int64))] = own["rank"].to_numpy(np.int64) - 1

    def nearest(text: str | None) -> tuple[str, float]:
        if not text or not names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        codes = _ranked(*grams(text), top)
        at = np.searchsorted(known, codes)
        at[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] != codes)] = len(known)
        other = ranks[:, at]
        distance = np.where(other < 0, top, np.abs(other - np.arange(len(codes)))).sum(axis=1)
        best = int(distance.argmin())
        return names[best], float(1 - distance[best] / (top * max(1, len(codes))))

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([nearest(t) for t in texts], columns=["lang_pred", "score"])

    return predicted(text)


def identify(docs: DataFrame, learned: DataFrame, text: str = "text", top: int = TOP) -> DataFrame:
    """``docs`` with lang_pred and score, see ``language``. Columns of ``docs`` with these names are replaced."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*(F.col(f"`{c}`").alias(f"in_{c}") for c in names)).withColumn("found", language(learned, f"in_{text}", top))
    return rows.select(*(F.col(f"`in_{c}`").alias(c) for c in names), "found.lang_pred", "found.score")
