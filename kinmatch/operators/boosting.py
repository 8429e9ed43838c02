"""Boosted trees on histograms, all of them in one barrier stage.

A tree has a pass over the rows for each level; as Spark jobs these passes cost more than their
work. Here each task keeps its rows as bins, one byte a feature, for the whole fit, and task 0 sums
the tasks' histograms over sockets and answers with the splits. Only histograms, splits and leaves
travel; no row is left out and none leaves its task.

Logistic loss with second derivatives: a leaf is -G / (H + 1), a child has an H of 2 at least, and
features are cut at up to 256 quantiles. Derivatives are whole multiples of a power of two, small
enough that every sum is exact, and a row's share in a tree depends on its key alone, so the way
rows are dealt to tasks doesn't matter. Nulls and NaN count as 0.
"""

from __future__ import annotations

import io
import secrets
import socket
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 256
CELLS = 65_536
STEP, ROW_SHARE, FEATURE_SHARE, LAMBDA, LEAST_H = 0.05, 0.85, 0.9, 1.0, 2.0
#: Seconds that a task waits for another one, which may have more rows.
PATIENCE = 1800


class Peers:
    """The tasks of a barrier stage, linked to task 0."""

    def __init__(self, context=None):
        infos = context.getTaskInfos() if context else [None]
        self.rank, self.links = (context.partitionId() if context else 0), []
        if len(infos) == 1:
            return
        server = socket.create_server(("", 0), backlog=len(infos)) if self.rank == 0 else None
        note = f"{server.getsockname()[1]} {secrets.token_hex(16)}" if server else ""
        port, token = context.allGather(note)[0].split()
        if server:
            server.settimeout(PATIENCE)
            while len(self.links) < len(infos) - 1:
                link = self._ready(server.accept()[0])
                got = bytearray(len(token))
                try:
                    self._read(link, memoryview(got))
                except OSError:
                    got = b""
                if secrets.compare_digest(bytes(got), token.encode()):
                    self.links.append(link)
                else:
                    link.close()
            server.close()
        else:
            hosts = [i.address.rsplit(":", 1)[0] for i in infos]
            host = "127.0.0.1" if hosts[0] == hosts[self.rank] else hosts[0]
            self.links = [self._ready(socket.create_connection((host, int(port)), PATIENCE))]
            self.links[0].sendall(token.encode())

    @staticmethod
    def _ready(link):
        link.settimeout(PATIENCE)
        link.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
        return link

    @staticmethod
    def _read(link, view) -> None:
        while len(view):
            n = link.recv_into(view)
            if not n:
                raise ConnectionError("a task of the fit has gone")
            view = view[n:]

    def gathered(self, a: np.ndarray, by=np.add) -> np.ndarray:
        """The arrays of all tasks, put together at task 0 (the others keep their own)."""
        a = np.ascontiguousarray(a)
        if self.rank:
            self.links[0].sendall(memoryview(a).cast("B"))
            return a
        other = np.empty_like(a)
        for link in self.links:
            self._read(link, memoryview(other).cast("B"))
            a = by(a, other)
        return a

    def told(self, a: np.ndarray) -> np.ndarray:
        """Task 0's array, for all; the others give one of its shape and type."""
        a = np.ascontiguousarray(a)
        if self.rank:
            a = np.empty_like(a)
            self._read(self.links[0], memoryview(a).cast("B"))
            return a
        for link in self.links:
            link.sendall(memoryview(a).cast("B"))
        return a

    def all(self, a: np.ndarray, by=np.add) -> np.ndarray:
        return self.told(self.gathered(a, by))

    def close(self) -> None:
        for link in self.links:
            link.close()


class Trees:
    """A fitted matcher: scales and bins of the features, and complete trees. `feature` and `bin`
    have an inner node a column, level by level (feature -1: all rows go left)."""

    FIELDS = ("lo", "span", "lut", "feature", "bin", "leaf")

    def __init__(self, lo, span, lut, feature, bin, leaf):
        self.lo, self.span, self.lut, self.feature, self.bin, self.leaf = lo, span, lut, feature, bin, leaf

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, **{k: getattr(self, k) for k in self.FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Trees:
        with np.load(io.BytesIO(data), allow_pickle=False) as found:
            return cls(*[found[k] for k in cls.FIELDS])

    def score(self, x: np.ndarray, block: int = 8192) -> np.ndarray:
        """The probability of a match of each row of features."""
        return np.concatenate([self._score(x[k : k + block]) for k in range(0, len(x), block)] or [np.empty(0)])

    def _score(self, x: np.ndarray) -> np.ndarray:
        bins = _bins(_cells(x, self.lo, self.span), self.lut)
        margin = np.zeros(len(x))
        for feature, cut, leaf in zip(self.feature.astype(np.int64), self.bin, self.leaf):
            margin += leaf[_leaves(bins, feature, cut)]
        return 1 / (1 + np.exp(-margin))


def _cells(x: np.ndarray, lo: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Cells of a fine grid, a row a feature."""
    at = np.nan_to_num((np.nan_to_num(x) - lo) / span * (CELLS - 1))
    return np.ascontiguousarray(np.clip(np.floor(at + 0.5), 0, CELLS - 1).astype(np.uint16).T)


def _bins(cells: np.ndarray, lut: np.ndarray) -> np.ndarray:
    return np.stack([lut[f][cells[f]] for f in range(len(cells))])


def _next(bins: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The rows' nodes a level deeper."""
    f = feature[node]
    right = (bins.reshape(-1)[np.maximum(f, 0) * bins.shape[1] + at] > cut[node]) & (f >= 0)
    return 2 * node + right


def _leaves(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    node, at, first = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1]), 0
    while first < len(feature):
        width = first + 1
        node = _next(bins, node, feature[first : first + width], cut[first : first + width], at)
        first += width
    return node


def _quantiles(counts: np.ndarray) -> np.ndarray:
    """The bin of each cell of a feature: a cell alone if few are taken, else about equal shares."""
    taken = np.flatnonzero(counts)
    bin_ = np.zeros(CELLS, np.int64)
    if len(taken) <= BINS:
        bin_[taken] = 1
        return (np.maximum(np.cumsum(bin_), 1) - 1).astype(np.uint8)
    share = np.minimum(counts, counts.sum() / BINS)
    raw = np.minimum((np.cumsum(share) - share / 2) * BINS / share.sum(), BINS - 1).astype(np.int64)
    return (np.cumsum(np.diff(raw, prepend=raw[0]) > 0)).astype(np.uint8)


def _drawn(key: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """Whether a row takes part in a tree: splitmix64 of its key."""
    z = key + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) < np.uint64(int(ROW_SHARE * 2**64))


def _best(hist: list[np.ndarray], feats: np.ndarray, scale: float):
    """The best split of each node: feature, bin, and G and H of both children."""
    m = hist[0].shape[1]
    gain, feature, cut = np.full(m, 1e-6), np.full(m, -1), np.zeros(m, np.int64)
    left, whole, at = np.zeros((2, m)), hist[0].sum(2) / scale, np.arange(m)
    parent = whole[0] ** 2 / (whole[1] + LAMBDA)
    for f, h in zip(feats, hist):
        if h.shape[2] < 2:
            continue
        gl, hl = np.cumsum(h[:, :, :-1], 2) / scale
        gr, hr = whole[0][:, None] - gl, whole[1][:, None] - hl
        found = gl * gl / (hl + LAMBDA) + gr * gr / (hr + LAMBDA) - parent[:, None]
        found[(hl < LEAST_H) | (hr < LEAST_H)] = -1
        k = found.argmax(1)
        better = found[at, k] > gain
        gain[better], feature[better], cut[better] = found[at, k][better], f, k[better]
        left[:, better] = gl[at, k][better], hl[at, k][better]
    return feature, cut, left, whole - left


def fit(x: np.ndarray, y: np.ndarray, key: np.ndarray, trees: int, depth: int, seed: int, peers: Peers) -> Trees:
    n, nf = x.shape
    x = np.nan_to_num(x)
    lo = peers.all(x.min(0) if n else np.full(nf, np.inf), np.minimum)
    hi = peers.all(x.max(0) if n else np.full(nf, -np.inf), np.maximum)
    lo, span = np.where(np.isfinite(lo), lo, 0.0), np.where(hi > lo, hi - lo, 1.0)
    cells = _cells(x, lo, span)
    del x
    counts = peers.gathered(np.stack([np.bincount(c, minlength=CELLS) for c in cells]))
    lut = peers.told(np.stack([_quantiles(c) for c in counts]))
    bins, width = _bins(cells, lut), lut.max(1).astype(np.int64) + 1
    del cells, counts
    neg, pos = peers.all(np.array([(y == 0).sum(), (y == 1).sum()], np.float64))
    weight = np.where(y == 1, max(1.0, neg / max(1.0, pos)), 1.0)
    scale = 2.0 ** (51 - int(np.ceil(np.log2(max(1.0, neg + pos * max(1.0, neg / max(1.0, pos)))))))
    margin, at, inner = np.zeros(n), np.arange(n), 2**depth - 1
    features, cuts, leaves = np.full((trees, inner), -1, np.int8), np.zeros((trees, inner), np.uint8), np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * weight * scale), np.rint(np.maximum(p * (1 - p), 1e-16) * weight * scale)
        feats = np.sort(np.random.default_rng([seed, t]).choice(nf, max(1, int(FEATURE_SHARE * nf)), replace=False))
        rows, node = np.flatnonzero(_drawn(key, seed, t)), np.zeros(n, np.int64)
        live, before, sums = np.array([0]), [], np.zeros((2, 1))  # nodes to split, histograms of the last level, G and H
        for level in range(depth):
            m = 2**level
            feature, cut = np.full(m, -1), np.zeros(m, np.int64)
            both = np.zeros((2, 2 * m))
            if len(live):
                # of two children the one with fewer rows is counted, the other is what is left of the parent
                small = live
                if level:
                    size = peers.all(np.bincount(node[rows], minlength=m).astype(np.float64))
                    pairs = live.reshape(-1, 2)
                    second = size[pairs[:, 1]] < size[pairs[:, 0]]
                    small = np.where(second, pairs[:, 1], pairs[:, 0])
                slot = np.full(m, -1)
                slot[small] = np.arange(len(small))
                own = slot[node[rows]]
                picked = np.flatnonzero(own >= 0)
                own, r = own[picked], rows[picked]
                hist = _histograms(bins, r, own, g[r], h[r], feats, width, len(small))
                hist = peers.gathered(hist)
                if not peers.rank:
                    found, first = [], 0
                    for k, f in enumerate(feats):
                        size_f = 2 * len(small) * width[f]
                        one = hist[first : first + size_f].reshape(2, len(small), width[f])
                        first += size_f
                        if level:
                            rest = before[k] - one
                            one = np.where(second[None, :, None, None], np.stack([rest, one], 2), np.stack([one, rest], 2)).reshape(2, len(live), width[f])
                        found.append(one)
                    feature[live], cut[live], left, right = _best(found, feats, scale)
                    both[:, 2 * live], both[:, 2 * live + 1] = left, right
                    split = feature[live] >= 0
                    before = [one[:, split] for one in found]
                told = peers.told(np.stack([feature, cut]))
                feature, cut = told
                node = _next(bins, node, feature, cut, at)
                shut = np.flatnonzero(feature < 0)
                whole = live[feature[live] < 0]
                if not peers.rank:
                    kept = both[:, 2 * whole] + both[:, 2 * whole + 1]
                    closed = np.setdiff1d(shut, whole)
                    both[:, 2 * closed] = sums[:, closed]
                    both[:, 2 * whole], both[:, 2 * whole + 1] = kept, 0
                parents = live[feature[live] >= 0]
                live = np.stack([2 * parents, 2 * parents + 1], 1).reshape(-1)
            else:
                node = 2 * node
                both[:, ::2] = sums
            sums = both
            features[t, m - 1 : 2 * m - 1], cuts[t, m - 1 : 2 * m - 1] = feature, cut
        leaves[t] = peers.told(-STEP * sums[0] / (sums[1] + LAMBDA))
        margin += leaves[t][node]
    return Trees(lo, span, lut, features, cuts, leaves)


def _histograms(bins, rows, slot, g, h, feats, width, slots: int) -> np.ndarray:
    """Sums of g and of h by feature, slot and bin, one after the other."""
    out, base = [], {}
    for f in feats:
        w = int(width[f])
        if w not in base:
            base[w] = slot * w
        at = base[w] + bins[f][rows]
        out += [np.bincount(at, g, slots * w), np.bincount(at, h, slots * w)]
    return np.concatenate(out)


def stage(names: list[str], trees: int, depth: int, seed: int):
    """The function of the barrier stage, over batches with `names`, label and key: one row, the
    model, from task 0."""

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import BarrierTaskContext

        x, y, key = [np.empty((0, len(names)))], [np.empty(0)], [np.empty(0, np.uint64)]
        for b in batches:
            column = lambda c: b.column(c).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            x.append(np.stack([column(c).astype(np.float64) for c in names], 1))
            y.append(column("label").astype(np.float64))
            key.append(column("key").astype(np.int64).view(np.uint64))
        peers = Peers(BarrierTaskContext.get())
        try:
            whole = np.concatenate(x)
            x.clear()
            made = fit(whole, np.concatenate(y), np.concatenate(key), trees, depth, seed, peers)
        finally:
            peers.close()
        if peers.rank == 0:
            yield pa.RecordBatch.from_pydict({"model": pa.array([made.to_bytes()], pa.binary())})

    return run


def scores(shared):
    """The function of a pandas UDF over the features, by a broadcast model."""

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        fitted = Trees.from_bytes(shared.value)
        for columns in batches:
            yield pd.Series(fitted.score(np.stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns], 1)))

    return run
