"""Token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.shared import ship

SPACE = "▁"
RUNS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Counts kept in a Python worker; beyond that the table starts anew.
MOST_KEPT = 600_000
#: Pre-tokens with more symbols take the agenda instead of the arrays, whose work grows with the square of the length.
LONG = 512
NEVER = np.iinfo(np.int32).max
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class PieceMerges:
    """The pairs of symbols that a byte-pair piece model merges: their rank (equal scores share one) and what they give."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, kinds = proto.normalizer_spec, {p.type for p in proto.pieces}
        plain = norm.name == "identity" and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or not plain or kinds & {USER_DEFINED, UNUSED}:
            raise ValueError("only byte-pair models with byte fallback, identity normaliser and plain pieces are supported")
        scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        if any(SPACE in piece.lstrip(SPACE) for piece in scores):
            raise ValueError("a piece holds a space after another symbol, so texts can't be cut at spaces")
        self.known = set(scores)
        symbols = {s: i for i, s in enumerate(dict.fromkeys(chain(scores, *scores)))}
        self.symbols = symbols
        #: Ids from here on are characters that no piece holds.
        self.stranger = len(symbols)
        self.ranks = {score: i for i, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.score_rank = {piece: self.ranks[s] for piece, s in scores.items()}
        pairs = [
            (symbols[piece[:i]] * (len(symbols) + 1) + symbols[piece[i:]], self.score_rank[piece], symbols[piece])
            for piece in scores
            for i in range(1, len(piece))
            if piece[:i] in symbols and piece[i:] in symbols
        ]
        keys, rank, merged = (np.array(x, dtype=np.int64) for x in zip(*sorted(pairs), strict=True))
        self.keys, self.rank, self.merged = keys, rank.astype(np.int32), merged.astype(np.int32)

    def looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, NEVER for those that don't merge, and its place in the table."""
        key = left.astype(np.int64) * (self.stranger + 1) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NEVER), at

    def counts(self, tokens: list[str]) -> list[int]:
        """Tokens of each pre-token."""
        out = np.zeros(len(tokens), dtype=np.int64)
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        for i in np.flatnonzero(lengths > LONG):
            out[i] = self.by_agenda(tokens[i])
        short = np.flatnonzero((lengths <= LONG) & (lengths > 0))
        if not len(short):
            return out.tolist()
        text = "".join(tokens[i] for i in short)
        get, stranger = self.symbols.get, self.stranger
        sym = np.fromiter((get(c, stranger) for c in text), dtype=np.int32, count=len(text))
        seq = np.repeat(np.arange(len(short)), lengths[short])
        # Characters that are no piece end as their UTF-8 bytes; what merges is one token in the end.
        worth = np.ones(len(text), dtype=np.int64)
        for i in np.flatnonzero(~np.isin(sym, self.alone)):
            worth[i] = len(text[i].encode())
        counts = np.bincount(seq, weights=worth, minlength=len(short)).astype(np.int64)
        lone = worth
        while len(sym) > 1:
            rank, at = self.looked_up(sym[:-1], sym[1:])
            rank = np.where(seq[:-1] == seq[1:], rank, NEVER)
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            least = np.minimum.reduceat(np.r_[rank, NEVER], starts)
            best = np.repeat(least, np.diff(np.r_[starts, len(seq)]))
            hits = np.flatnonzero((rank == best[:-1]) & (rank < NEVER))
            if not len(hits):
                break
            # The leftmost pair of least rank of every sequence, all at once.
            first = hits[np.r_[True, seq[hits[1:]] != seq[hits[:-1]]]]
            counts[seq[first]] -= lone[first] + lone[first + 1] - 1
            sym, lone = sym.copy(), lone.copy()
            sym[first], lone[first] = self.merged[at[first]], 1
            keep = best < NEVER  # sequences that are done leave
            keep[first + 1] = False
            sym, seq, lone = sym[keep], seq[keep], lone[keep]
        out[short] = counts
        return out.tolist()

    @property
    def alone(self) -> np.ndarray:
        if not hasattr(self, "_alone"):
            self._alone = np.array(sorted(i for s, i in self.symbols.items() if s in self.known), dtype=np.int32)
        return self._alone

    def by_agenda(self, token: str) -> int:
        """The same count for one long pre-token, with a queue of pairs instead of arrays."""
        parts: list[str | None] = list(token)
        left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        rank = self.score_rank.get
        queue = [(r, i, a + b) for i, (a, b) in enumerate(zip(token, token[1:], strict=False)) if (r := rank(a + b)) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, piece = heapq.heappop(queue)
            j = right[i]
            if parts[i] is None or j < 0 or parts[i] + parts[j] != piece:
                continue
            parts[i], parts[j] = piece, None
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and (r := rank(parts[a] + parts[b])) is not None:
                    heapq.heappush(queue, (r, a, parts[a] + parts[b]))
        return sum(1 if p in self.known else len(p.encode()) for p in parts if p is not None)


def pre_tokens(text: str) -> list[str]:
    """The text cut before each run of spaces. A word after a single space comes without it; runs keep theirs, escaped.

    The model puts a space in front of every text.
    """
    if not text:
        return []
    words = text.replace(SPACE, " ").split(" ")
    if "" in words:
        return RUNS.findall(SPACE + text.replace(" ", SPACE))
    return words


@lru_cache(maxsize=2)
def _merges(model: bytes) -> tuple[PieceMerges, dict[str, int]]:
    return PieceMerges(model), {}


def count_texts(texts: list[str | None], merges: PieceMerges, kept: dict[str, int]) -> list[int]:
    """Tokens of each text. Pre-tokens new to this worker are merged together, the others looked up."""
    cut = [pre_tokens(t or "") for t in texts]
    if len(kept) > MOST_KEPT:
        kept.clear()
    new = list(set().union(*cut).difference(kept))
    kept.update(zip(new, merges.counts([w if w[0] == SPACE else SPACE + w for w in new]), strict=True))
    return [sum(map(kept.__getitem__, words)) for words in cut]


def token_count(spark: SparkSession, model_path: str, text: str | Column = "text") -> Column:
    """Number of tokens that the piece model at ``model_path`` (on the driver) cuts each text into, without begin and end.

    Null and empty texts have none. Texts are read whole; very long runs without a space take a queue of pairs instead of the
    arrays. The model's file, of a fixed size, is broadcast. Equal texts give equal counts in any order of rows;
    an empty table gives no rows. Only the text column is read.
    """
    ship(spark)
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        merges, kept = _merges(model.value)
        for texts in batches:
            yield pd.Series(count_texts(texts.tolist(), merges, kept), dtype="int64")

    return count(text)
