"""Distinct sampled segmentations: Gumbel top-k without replacement over the lattice of pieces, and decoding."""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from lodestrata.llm.shared import give_back, id_parts, ship
from lodestrata.llm.token_counts import BYTE, NORMAL, SPACE, pre_tokens
from lodestrata.llm.words import mixed, portions

#: Exponent on the weights: below 1 the segmentations are more even.
THETA = 0.5
#: A branch whose prefix has a probability below e to minus this never comes first (chance under 1e-26) and isn't looked at.
DEEP = 60.0
#: Tokens of a path that are looked at first; most paths are that deep, and those that are not yet get a wider array.
WIDTH = 384
#: Pre-tokens whose lattices are made at a time, in arrays that stay in a processor's cache.
CHUNK = 4_000
#: Edges of lattices that a task keeps for later texts, and edges for which it has room, those of a portion included.
KEPT, ROOM = 2_000_000, 3_500_000
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


class Pieces:
    """The vocabulary for lattices: hashes of all beginnings of pieces, the piece each stands for, and weights."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        pieces = [(i, p.piece, p.score) for i, p in enumerate(proto.pieces) if p.type == NORMAL]
        byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        if len(byte) != 256 or any(SPACE in p.lstrip(SPACE) for _, p, _ in pieces):
            raise ValueError("only models with byte fallback and no space after another symbol in a piece are supported")
        self.names = [p.piece for p in proto.pieces]
        self.bytes_of = np.array([byte[b] for b in range(256)], dtype=np.int32)
        #: What each token adds to a text: its piece with spaces as such, or one byte.
        self.spelled = [p.piece.replace(SPACE, " ").encode() for p in proto.pieces]
        for b, i in byte.items():
            self.spelled[i] = bytes([b])
        self.spelled = np.array(self.spelled, dtype=object)
        # Scores of byte-pair models only rank the pieces; their weights then follow Zipf's law. Others are log probabilities.
        order = sorted(pieces, key=lambda x: (-x[2], x[0]))
        if proto.trainer_spec.model_type == 2:
            total = np.log((1 / (np.arange(len(order)) + 2.7)).sum())
            weight = {i: -np.log(r + 2.7) - total for r, (i, _, _) in enumerate(order)}
        else:
            weight = {i: s for i, _, s in pieces}
        self.byte_weight = min(weight.values()) - 1.0
        # A tree of the beginnings in an open table: each lies at the place that a hash of its own beginning's place and its last character names, or at the next free one.
        ends: dict[str, int] = {}
        for i, piece, _ in pieces:
            for j in range(1, len(piece) + 1):
                ends[piece[:j]] = i if j == len(piece) else ends.get(piece[:j], -1)
        size = 1 << (4 * len(ends)).bit_length()
        self.shift = 65 - size.bit_length()
        self.keys = np.full(size, -1, dtype=np.int64)
        self.piece, self.weight = np.full(size, -1, dtype=np.int32), np.full(size, -np.inf)
        place = {"": -1}
        for beginning in sorted(ends, key=len):
            key = (place[beginning[:-1]] + 1 << 21) | ord(beginning[-1])
            at = (key * int(_BASE) & 0xFFFFFFFFFFFFFFFF) >> self.shift
            while self.keys[at] >= 0:
                at = (at + 1) & (size - 1)
            p = ends[beginning]
            place[beginning], self.keys[at], self.piece[at], self.weight[at] = at, key, p, weight.get(p, -np.inf)
        self.whole = self.piece >= 0
        self.longest = max(len(p) for _, p, _ in pieces)
        #: For each theta the pre-tokens whose lattices are kept, with their numbers, the lattices, and arrays that begin with these.
        self.kept: dict[float, tuple[dict[str, int], Lattices, dict[str, np.ndarray]]] = {}

    def places(self, state: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the table of beginnings made longer by a character, and which are there; ``state``: the place of the beginning plus 1, or 0 for none."""
        key = (state << 21) | points
        at = ((key.view(_U) * _BASE) >> _U(self.shift)).view(np.int64)
        got = self.keys[at]
        alive = got == key
        look = np.flatnonzero(~alive & (got >= 0))
        while len(look):
            at[look] = (at[look] + 1) & (len(self.keys) - 1)
            got = self.keys[at[look]]
            alive[look] = got == key[look]
            look = look[(got >= 0) & (got != key[look])]
        return at, alive


class Lattices:
    """Lattices of many pre-tokens side by side. A node is a character; edges are sorted by node, with their chance there.

    Nodes lie by their distance from the end of their pre-token, and those of one distance by pre-token, longest first. The backward pass, which sums
    the weights of all ways to the end, thus takes the nodes of each distance, and their edges, as one stretch. ``end`` stands for the end of all pre-tokens.
    """

    end = int(np.iinfo(np.int32).max)

    def __init__(self, tokens: list[str], pieces: Pieces, theta: float):
        points = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        by_length = np.argsort(-lengths, kind="stable")
        most = int(lengths.max()) if len(lengths) else 0
        wide = np.searchsorted(-lengths[by_length], -np.arange(1, most + 1), side="right")
        offset = np.r_[0, np.cumsum(wide)]
        n = len(points)
        every = np.arange(n)
        self.start = np.empty(len(tokens), dtype=np.int64)
        self.start[by_length] = offset[lengths[by_length] - 1] + np.arange(len(tokens))
        left = np.repeat(np.arange(1, most + 1), wide)
        rank = every - offset[left - 1]
        points = points[np.cumsum(lengths)[by_length][rank] - left]
        #: The node of the next character.
        after = np.where(left > 1, every - np.r_[0, wide][left - 1], n)
        del left, rank
        begin, cur, state, found = every, every, np.zeros(n, dtype=np.int64), []
        lone, counts = np.ones(n, dtype=bool), np.zeros(n, dtype=np.int64)
        for size in range(1, pieces.longest + 1):
            place, alive = pieces.places(state, points.take(cur))
            some = np.flatnonzero(alive)
            begin, place, cur = begin.take(some), place.take(some), after.take(cur.take(some))
            some = np.flatnonzero(pieces.whole.take(place))
            found.append((begin.take(some), cur.take(some), place.take(some)))
            counts[found[-1][0]] += 1
            if size == 1:
                lone[found[-1][0]] = False
            some = np.flatnonzero(cur < n)
            begin, cur, state = begin.take(some), cur.take(some), place.take(some) + 1
        # Characters that are no piece become their UTF-8 bytes: one edge, told by a piece below zero.
        bare = np.flatnonzero(lone)
        p = points[bare]
        width = 1 + (p > 0x7F) + (p > 0x7FF) + (p > 0xFFFF)
        counts[bare] += 1
        # A node has at most one edge of each kind, so edges go to their places without a sort: long pieces, mostly the likely ones, first.
        self.first = np.r_[0, np.cumsum(counts)]
        free = self.first[:-1].copy()
        spots, free[bare] = free[bare], free[bare] + 1
        self.to, places = np.empty(self.first[-1], dtype=np.int32), np.zeros(self.first[-1], dtype=np.int32)
        self.to[spots] = after[bare]
        for begin, to, place in reversed(found):
            spot = free.take(begin)
            self.to[spot], places[spot] = to, place
            free[begin] = spot + 1
        del found, begin, cur, state, place, after
        self.piece, self.log = pieces.piece.take(places), theta * pieces.weight.take(places)
        self.piece[spots], self.log[spots] = -1 - p, theta * width * pieces.byte_weight
        #: The chances of a node's edges summed up to each; over 1 at its last.
        self.ladder = np.empty(len(self.to))
        beta, owner = np.zeros(n + 1), np.repeat(every, counts)
        for a, b in zip(offset[:-1].tolist(), offset[1:].tolist(), strict=True):
            lo, hi = self.first[a], self.first[b]
            starts, own = self.first[a:b] - lo, owner[lo:hi] - a
            value = self.log[lo:hi] + beta.take(self.to[lo:hi])
            top = np.maximum.reduceat(value, starts)
            chance = np.exp(value - top.take(own))
            total = np.add.reduceat(chance, starts)
            beta[a:b] = top + np.log(total)
            np.subtract(value, beta[a:b].take(own), out=self.log[lo:hi])
            chance /= total.take(own)
            total = np.cumsum(chance)
            np.subtract(total, (total.take(starts) - chance.take(starts)).take(own), out=self.ladder[lo:hi])
        self.ladder[self.first[1:] - 1] = 2.0
        #: Edges that are the only one of their node.
        self.lone = (counts == 1).take(owner)
        self.to[self.to == n] = self.end

    @classmethod
    def of(cls, tokens: list[str], pieces: Pieces, theta: float, kept: Lattices | None = None, room: dict[str, np.ndarray] | None = None) -> Lattices:
        """Lattices of any number of pre-tokens, made CHUNK by CHUNK and put side by side, behind those of the pre-tokens that are ``kept``.

        ``room``: arrays that begin with those of ``kept``. What fits is put there, and written over when they are given again.
        """
        parts = [cls(tokens[i : i + CHUNK], pieces, theta) for i in range(0, len(tokens), CHUNK)]
        if kept is not None:
            parts.insert(0, kept)
        nodes = edges = 0
        for p in parts:
            if p is not kept:
                p.start += nodes
                p.to[p.to != cls.end] += nodes
                p.first += edges
            nodes, edges = nodes + len(p.first) - 1, edges + len(p.to)
        out = object.__new__(cls)
        out.start = np.concatenate([p.start for p in parts])
        for name in ("first", "to", "piece", "log", "ladder", "lone"):
            own = [getattr(p, name) for p in parts]
            if name == "first":
                own[:-1] = [first[:-1] for first in own[:-1]]
            if room is None or edges >= ROOM:
                setattr(out, name, np.concatenate(own))
                continue
            if name not in room:
                room[name] = np.empty(ROOM, dtype=own[0].dtype)
                at = 0
            else:
                at = len(own.pop(0))
            whole = room[name]
            for x in own:
                whole[at : at + len(x)] = x
                at += len(x)
            setattr(out, name, whole[:at])
        return out

    def edges(self, edge: int) -> range:
        """All edges of the node of an edge."""
        node = int(np.searchsorted(self.first, edge, side="right"))
        return range(int(self.first[node - 1]), int(self.first[node]))

    def pick(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each node whose stretch of chance holds the number u; few are passed over, as the likely ones come first."""
        edge = self.first[node]
        more = np.flatnonzero(self.ladder[edge] <= u)
        while len(more):
            edge[more] += 1
            more = more[self.ladder[edge[more]] <= u[more]]
        return edge


def uniform(seed: np.ndarray | np.uint64, *counters) -> np.ndarray:
    """Numbers between 0 and 1 that depend on their seed and counters only."""
    return _uniform(_counted(np.atleast_1d(np.asarray(seed, dtype=_U)), *counters))


def _counted(h: np.ndarray, *counters) -> np.ndarray:
    for c in counters:
        h = h * _BASE + (_U(c + 1) if isinstance(c, int) else c.astype(_U) + _U(1))
    return h


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((mixed(h) >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)


def _walk(lattices: Lattices, token: np.ndarray, seed: np.ndarray, place: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """One path through every pre-token, drawn edge by edge for all of them together: the edges, and where each pre-token's begin."""
    occ, node, step, drawn, h = np.arange(len(token)), lattices.start[token], 0, [], _counted(seed, sample, place)
    while len(occ):
        edge = lattices.pick(node, _uniform(_counted(h, step)))
        drawn.append((occ, edge))
        node = lattices.to[edge]
        more = node < lattices.end
        occ, node, step, h = occ[more], node[more], step + 1, h[more]
    counts = np.bincount(np.concatenate([o for o, _ in drawn]), minlength=len(token)) if drawn else np.zeros(0, np.int64)
    starts = np.r_[0, np.cumsum(counts)]
    path = np.empty(starts[-1], dtype=np.int64)
    for step, (occ, edge) in enumerate(drawn):
        path[starts[occ] + step] = edge
    return path, starts


def _below(location, limit: float, u):
    """A Gumbel variable given that it is at most ``limit``."""
    return location - np.log(np.exp(np.minimum(location - limit, 700.0)) - np.log(u))


#: An entry of a text's queue: minus its priority, a number that settles ties, and (path, place of the branch, edges taken there).
Entry = tuple[float, int, tuple[np.ndarray, int, tuple[int, ...]]]


def _branches(lattices: Lattices, paths: list[np.ndarray], since: np.ndarray, taken: list[tuple[int, ...]], value: np.ndarray, seed: np.ndarray, ticket: np.ndarray, k: int) -> list[list[Entry]]:
    """The branches that leave new paths at ``since`` or later, a path for each of many texts: per text its k + 1 largest.

    No more than k entries leave a queue and one bounds the rest, so these are enough. Only the beginnings of paths down to ``DEEP`` are looked at; these
    lie side by side in an array, longer ones in a wider array of their own, so a value does not depend on the texts beside it. ``ticket`` is counted up.
    """
    out: list[list[Entry]] = [[] for _ in paths]
    length = np.fromiter(map(len, paths), dtype=np.int64, count=len(paths))
    rows, width = np.arange(len(paths)), min(WIDTH, int(length.max()))
    while len(rows):
        spots = np.arange(width)
        there = spots < length[rows, None]
        edge = np.zeros(there.shape, dtype=np.int64)
        edge[there] = np.concatenate([paths[i][:width] for i in rows.tolist()])
        log = np.where(there, lattices.log[edge], 0.0)
        before = np.zeros((len(rows), width + 1))
        np.cumsum(log, axis=1, out=before[:, 1:])
        last = np.minimum((before > -DEEP).sum(axis=1), length[rows])
        ended = (last < width) | (length[rows] <= width)
        ticket[rows[ended & (since[rows] < last)]] += 1
        free = -np.expm1(np.minimum(log, 0.0))
        free[lattices.lone[edge]] = 0.0
        for r in np.flatnonzero(ended & (since[rows] < last)).tolist():
            i = rows[r]
            if taken[i]:
                used = (*taken[i], int(paths[i][since[i]]))
                open_edges = [e for e in lattices.edges(used[-1]) if e not in used]
                free[r, since[i]] = np.exp(lattices.log[open_edges]).sum() if open_edges else 0.0
        r, t = np.nonzero(ended[:, None] & (spots >= since[rows, None]) & (spots < last[:, None]) & (free > 0))
        owner = rows[r]
        values = _below(before[r, t] + np.log(free[r, t]), value[owner], uniform(seed[owner], 1 << 40, ticket[owner], t))
        best = np.full(there.shape, -np.inf)
        best[r, t] = values
        for _ in range(min(k + 1, width)):
            t = best.argmax(axis=1)
            values = best[np.arange(len(rows)), t]
            for r in np.flatnonzero(values > -np.inf).tolist():
                i, spot = int(rows[r]), int(t[r])
                out[i].append((-float(values[r]), (int(ticket[i]) << 32) + spot, (paths[i], spot, taken[i] if spot == since[i] else ())))
            best[np.arange(len(rows)), t] = -np.inf
        rows, width = rows[~ended], 4 * width
    return out


def _best(lattices: Lattices, walks: list[tuple[np.ndarray, np.ndarray]], bounds: np.ndarray, seeds: np.ndarray, k: int) -> tuple[list[list[tuple[float, np.ndarray]]], list[float]]:
    """Of each text the k segmentations with the largest perturbed log probability, and the largest of those left out.

    A-star over the tree of prefixes: an entry of a text's queue is a prefix together with the edges after it that are still
    free, and its priority is the exact maximum of the perturbed values below. The largest leaves the queue; an edge is
    drawn, the rest of the text follows from a fresh walk, and the branches along the new path enter, bounded by its value.
    Every text has a queue of its own; all texts take a step before any takes the next.
    """
    path, starts = walks[0]
    paths = [path[a:b] for a, b in zip(starts[bounds[:, 0]], starts[bounds[:, 1]], strict=True)]
    value, ticket = -np.log(-np.log(uniform(seeds, 1 << 41))), np.zeros(len(paths), dtype=np.int64)
    out = [[(float(v), p)] for v, p in zip(value, paths, strict=True)]
    queues = _branches(lattices, paths, np.zeros(len(paths), dtype=np.int64), [()] * len(paths), value, seeds, ticket, k)
    for queue in queues:
        heapq.heapify(queue)
    for j in range(1, k):
        going = [i for i, queue in enumerate(queues) if queue]
        if not going:
            break
        at, drawn = np.array(going), uniform(seeds[going], 1 << 42, j)
        fresh, starts = walks[j]
        popped, edge, taken = [], np.empty(len(going), dtype=np.int64), []
        for r, (i, u) in enumerate(zip(going, drawn.tolist(), strict=True)):
            minus, _, (path, t, gone) = heapq.heappop(queues[i])
            used = (*gone, int(path[t]))
            free = [e for e in lattices.edges(used[-1]) if e not in used]
            chance = np.cumsum(np.exp(lattices.log[free]))
            edge[r] = free[min(int(np.searchsorted(chance, u * chance[-1])), len(free) - 1)]
            popped.append((path, t))
            taken.append(used)
            value[i] = -minus
        # The rest of the pre-tokens that the branches lie in, for all texts together.
        tails, step, rows = [[e] for e in edge.tolist()], 0, np.arange(len(going))
        while True:
            node = lattices.to[edge]
            rows, node = rows[node < lattices.end], node[node < lattices.end]
            if not len(rows):
                break
            edge = lattices.pick(node, uniform(seeds[at[rows]], 1 << 43, j, step))
            for r, e in zip(rows.tolist(), edge.tolist(), strict=True):
                tails[r].append(e)
            step += 1
        paths, since = [], [t for _, t in popped]
        for i, (path, t), tail in zip(going, popped, tails, strict=True):
            # The pre-token that the branch lies in, counted by its ends along the path.
            done = int((lattices.to[path[:t]] == lattices.end).sum())
            paths.append(np.concatenate([path[:t], tail, fresh[starts[bounds[i, 0] + done + 1] : starts[bounds[i, 1]]]]))
            out[i].append((float(value[i]), paths[-1]))
        tickets = ticket[at]
        entered = _branches(lattices, paths, np.array(since), taken, value[at], seeds[at], tickets, k)
        ticket[at] = tickets
        for i, entries in zip(going, entered, strict=True):
            for entry in entries:
                heapq.heappush(queues[i], entry)
    return out, [-queue[0][0] if queue else -np.inf for queue in queues]


@lru_cache(maxsize=2)
def _pieces(model: bytes) -> Pieces:
    return Pieces(model)


def ids_of(paths: list[np.ndarray], lattices: Lattices, pieces: Pieces) -> list[np.ndarray]:
    """Token ids of paths; characters that are no piece give a token for each byte."""
    ends = np.cumsum([len(p) for p in paths])
    ids = lattices.piece[np.concatenate(paths)]
    times = np.ones(len(ids), dtype=np.int64)
    bare = np.flatnonzero(ids < 0)
    points, which = np.unique(-1 - ids[bare], return_inverse=True)
    spelled = [pieces.bytes_of[list(chr(p).encode("utf-8", "surrogatepass"))] for p in points.tolist()]
    times[bare] = np.array([len(s) for s in spelled], dtype=np.int64)[which]
    out = np.repeat(ids, times).astype(np.int32)
    if len(bare):
        out[out < 0] = np.concatenate([spelled[w] for w in which.tolist()])
    return np.split(out, np.cumsum(times)[ends[:-1] - 1])


def spelled(ids: np.ndarray, pieces: Pieces) -> bytes:
    """The UTF-8 text of token ids: bytes joined, spaces as such, and without the space in front."""
    return b"".join(pieces.spelled[ids].tolist()).removeprefix(b" ")


def decoded(ids: np.ndarray, pieces: Pieces) -> str:
    return spelled(np.asarray(ids, dtype=np.int64), pieces).decode("utf-8", "replace")


def _lattices(cut: list[list[str]], size: int, pieces: Pieces, theta: float) -> tuple[np.ndarray, Lattices]:
    """Number of each of ``size`` pre-tokens among the distinct ones, and the lattices of these.

    Half of the distinct pre-tokens of a portion, the frequent ones, came before in a few others; their lattices are kept, up to KEPT edges.
    """
    words, kept, room = pieces.kept.get(theta, ({}, None, {}))
    distinct: defaultdict[str, int] = defaultdict(None, words)
    distinct.default_factory = distinct.__len__
    token = np.fromiter(map(distinct.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=size)
    fresh = [w if w[0] == SPACE else SPACE + w for w in islice(distinct, len(words), None)]
    if not fresh:
        return token, kept
    lattices = Lattices.of(fresh, pieces, theta, kept, room)
    if len(lattices.to) <= KEPT:
        pieces.kept[theta] = dict(distinct), lattices, room
    return token, lattices


def sampled(texts: list[str | None], keys: list[str], pieces: Pieces, k: int, theta: float, seed: int) -> list[list[tuple]]:
    """For each text its k sampled segmentations: (ids, log probability, perturbed value, log of the chance of inclusion)."""
    cut = [pre_tokens(t or "") for t in texts]
    seeds = np.array([xxh3_64_intdigest(f"{seed}:{key}".encode()) for key in keys], dtype=_U)
    bounds = np.r_[0, np.cumsum([len(words) for words in cut])].astype(np.int64)
    if not bounds[-1]:
        return [[(np.zeros(0, np.int32), 0.0, 0.0, 0.0)] for _ in texts]
    token, lattices = _lattices(cut, int(bounds[-1]), pieces, theta)
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    place = np.arange(len(token)) - bounds[row]
    walks = [_walk(lattices, token, seeds[row], place, j) for j in range(k)]
    out: list[list[tuple]] = [[(np.zeros(0, np.int32), 0.0, 0.0, 0.0)] for _ in texts]
    some = np.flatnonzero(np.diff(bounds))
    best, left_out = _best(lattices, walks, np.stack([bounds[some], bounds[some + 1]], axis=1), seeds[some], k)
    ids = iter(ids_of([path for found in best for _, path in found], lattices, pieces))
    for i, found, bound in zip(some.tolist(), best, left_out, strict=True):
        out[i] = []
        for value, path in found:
            log = float(lattices.log[path].sum())
            # Included if its own Gumbel variable exceeds the largest value left out: 1 - exp(-exp(log - bound)).
            inside = 0.0 if bound == -np.inf else float(np.log(-np.expm1(-np.exp(min(log - bound, 700.0))))) if log - bound > -30 else log - bound
            out[i].append((next(ids), log, value, inside))
    return out


def encode_samples(docs: DataFrame, model_path: str, k: int = 2, theta: float = THETA, seed: int = 29, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """k distinct segmentations of each whole text: id, sample (from 1, by falling perturbed value), n_tokens, log_prob, gumbel, log_inclusion, ids, ids_crc32, same_text, decoded_crc32.

    A segmentation's probability is proportional to the product of its pieces' weights to the power ``theta``. The k are drawn without
    replacement: they have the largest log probabilities after a Gumbel variable is added to each. log_inclusion is the log
    of the chance that a segmentation would be among them, given the largest value left out. Random numbers depend on ``seed`` and the row's id only, so
    reruns and other partitionings agree, and rows that repeat id and text get the same samples. The ids are then spelled again, as ``decode`` does: same_text tells whether that gives the text back (a literal ▁ comes back as a space), decoded_crc32 is of what it gives.

    A null or empty text has one segmentation, without tokens; texts with fewer than k segmentations give all they have. A very long text is a portion of
    its own, in arrays of its length. An empty table gives an empty result. Other columns are not read, whatever their names. The model's file, of a
    fixed size, is broadcast.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    columns = ["id", "sample", "n_tokens", "log_prob", "gumbel", "log_inclusion", "ids", "ids_crc32", "same_text", "decoded_crc32"]

    def rows_of(batch: pd.DataFrame, pieces: Pieces) -> pd.DataFrame:
        texts = batch["text"].tolist()
        keys = batch["key"].tolist()
        found = [best for part in portions(texts) for best in sampled(texts[part], keys[part], pieces, k, theta, seed)]
        owners = batch["id"].astype("Int64").where(batch["there"])
        rows = []
        for ident, body, best in zip(owners, texts, found, strict=True):
            plain = (body or "").replace(SPACE, " ").encode("utf-8", "surrogatepass")
            for j, (ids, log, value, inside) in enumerate(best, 1):
                back = spelled(ids, pieces)
                told = back if back == plain else back.decode("utf-8", "replace").encode()
                rows.append((ident, j, len(ids), log, value, inside, ids, zlib.crc32(ids.tobytes()), told == plain, zlib.crc32(told)))
        return pd.DataFrame(rows, columns=columns).astype({"id": "Int64"})

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = _pieces(model.value)
        for batch in batches:
            yield rows_of(batch, pieces)
        pieces.kept.clear()
        give_back()

    rows = docs.select(*id_parts(id_col), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text"))
    out = rows.mapInPandas(drawn, "id long, sample int, n_tokens long, log_prob double, gumbel double, log_inclusion double, ids array<int>, ids_crc32 long, same_text boolean, decoded_crc32 long")
    return out.withColumnRenamed("id", id_col)


def decode(spark: SparkSession, model_path: str, ids: str | Column = "ids") -> Column:
    """The text of a column of token ids; null for null."""
    ship(spark)
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = _pieces(model.value)
        for batch in batches:
            yield pd.Series([None if x is None else decoded(x, pieces) for x in batch], dtype=object)

    return text(ids)
