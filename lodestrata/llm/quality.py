"""Text quality: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from lodestrata.llm.shared import ship, stored
from lodestrata.llm.words import mixed

BINS = 1 << 18
#: Labelled documents that the model is fitted on at most, and passes over them.
SAMPLE, EPOCHS = 8192, 2
#: Features share this much weight, so that scores do not depend on a text's length.
SCALE = 16.0
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.5
MOST_KEPT = 400_000
AGAIN = np.uint64(1)  # stands for a word that repeats the one before it


class WordParts(dict):
    """A word as a number: hash of its letters in lower case (32 bits), its case (8) and a hash of its closing signs (16)."""

    def __missing__(self, word: str) -> int:
        if len(self) > MOST_KEPT:
            self.clear()
        core = word.rstrip(".,;:!?*#$%&|\"')]}>-_=+~/\\")
        signs = word[len(core) :]
        case = 0 if not core else 1 if core.islower() else 2 if core[0].isupper() and core[1:].islower() else 3 if core.isupper() and len(core) > 1 else 4
        low = xxh3_64_intdigest(core.lower().encode("utf-8", "surrogatepass")) & 0xFFFFFFFF
        end = xxh3_64_intdigest(signs.encode()) & 0xFFFF if signs else 0
        value = self[word] = (low << 24) | (case << 16) | end
        return value


_PARTS = WordParts()


def features(text: str | None, bins: int = BINS) -> np.ndarray:
    """The bin of every word n-gram of a text, with repeats.

    Words in lower case give 1- and 2-grams, where a word that repeats the one before it counts as a sign of its own; the
    words' case and closing signs give 1- and 2-grams as well.
    """
    words = text.split() if text else []
    if not words:
        return np.zeros(0, dtype=np.int64)
    packed = np.fromiter(map(_PARTS.__getitem__, words), dtype=np.uint64, count=len(words))
    core, case, end = packed >> np.uint64(24), (packed >> np.uint64(16)) & np.uint64(0xFF), packed & np.uint64(0xFFFF)
    core[1:][packed[1:] == packed[:-1]] = AGAIN
    streams = []
    for kind, stream in enumerate((core, case, end)):
        one = stream * np.uint64(8) + np.uint64(kind)
        streams += [one, mixed(one[:-1]) * np.uint64(31) + one[1:]]
    return (mixed(np.concatenate(streams)) % np.uint64(bins)).astype(np.int64)


class Leader:
    """Per-coordinate follow-the-regularised-leader: sums of gradients and of their squares, weights from both."""

    def __init__(self, bins: int = BINS):
        self.z, self.n = np.zeros(bins + 1), np.zeros(bins + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (sigmoid(w @ x) - label) * x
        more = np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])
        self.z[at] += g - more / ALPHA * w
        self.n[at] += g * g


def sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last is the bias) learned from the texts of at most ``sample`` labelled ids, chosen and ordered by a hash of the id.

    The ids are chosen from ``labels`` alone, so only their texts are moved. These stream through one task, text by text, which holds
    no more than a batch. An id with several labels takes the largest; null labels and ids take no part. Without labelled rows, or without
    texts, all weights are 0. Null and empty texts teach the bias alone, very long ones are read whole, and each row of a repeated id is learned from. Other
    columns are not read, whatever their names.
    """
    ship(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    known = stored(known.withColumn("at", F.xxhash64("id", F.lit("fit"))).orderBy("at", "id").limit(sample), "quality-sample")
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
    rounds = chosen.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).repartition(1).sortWithinPartitions("epoch", "at", F.xxhash64("text"))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Leader()
        for batch in batches:
            for body, label in zip(batch["text"], batch["label"], strict=True):
                bins = features(body)
                at, counts = np.unique(bins, return_counts=True)
                model.learn(np.r_[at, BINS], np.r_[counts * (SCALE / max(1, len(bins))), 1.0], int(label))
        yield pd.DataFrame({"weights": [model.weights(slice(None)).astype(np.float32).tobytes()]})

    found = rounds.select("text", "label").mapInPandas(learn, "weights binary").collect()
    return np.frombuffer(found[0]["weights"], dtype=np.float32) if found else np.zeros(BINS + 1, dtype=np.float32)


def quality(spark: SparkSession, weights: np.ndarray, text: str | Column = "text") -> Column:
    """The probability of label 1 for each whole text, as the dot product of its n-grams with the weights.

    Null and empty texts, and texts without words, get the bias alone. Very long texts are read whole, repeated rows get equal
    scores, an empty table gives no rows. Only the text column is read. The weights, of a fixed size, are broadcast.
    """
    ship(spark)
    sent = spark.sparkContext.broadcast(weights.astype(np.float64))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        w = sent.value
        out = np.empty(len(texts))
        for i, body in enumerate(texts):
            bins = features(body)
            out[i] = w[-1] + (w[bins].sum() * SCALE / len(bins) if len(bins) else 0.0)
        return pd.Series(sigmoid(out))

    return scored(text)
