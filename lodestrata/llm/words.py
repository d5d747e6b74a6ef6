"""Words of a text as 64-bit hashes, for operators that count or compare them in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from xxhash import xxh3_64_intdigest

MOST_KEPT = 150_000
#: Characters whose arrays a task holds at a time, unless one text is longer.
AT_ONCE = 1_000_000
END = 0x9E3779B97F4A7C15
#: Rows that are hashed at a time: their numbers stay in the processor's cache.
BLOCK = 1 << 14


class WordHashes(dict):
    """Hash of a word, kept for the words a worker has met; starts anew when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MOST_KEPT:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value


def portions(texts: list[str | None], most: int = AT_ONCE) -> Iterator[slice]:
    """Runs of texts with at most ``most`` characters together; a longer text is a run of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        own = len(text) if text else 0
        if i > start and size + own > most:
            yield slice(start, i)
            start, size = i, 0
        size += own
    if len(texts) > start:
        yield slice(start, len(texts))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case. bytes.split() knows exactly the six characters of the contracts."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hashes_of(text: str | None, kept: WordHashes) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(kept.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every bit of the input reaches every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chained(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of equally long columns; the order of the columns counts."""
    out = np.zeros(len(parts[0]), dtype=np.uint64)
    spare = np.empty(min(len(out), BLOCK), dtype=np.uint64)
    for start in range(0, len(out), BLOCK):
        x = out[start : start + BLOCK]
        y = spare[: len(x)]
        for p in parts:
            x *= np.uint64(0x9E3779B97F4A7C15)
            x += p[start : start + BLOCK]
            x += np.uint64(1)
            # As ``mixed``, in place.
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
                np.right_shift(x, np.uint64(shift), out=y)
                x ^= y
                if factor > 1:
                    x *= np.uint64(factor)
    return out


def shingles(text: str | None, size: int, kept: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; fewer words make one shingle, none make none."""
    words = hashes_of(text, kept)
    if not len(words):
        return words
    size = min(size, len(words))
    return np.unique(chained([words[i : len(words) - size + 1 + i] for i in range(size)]))
