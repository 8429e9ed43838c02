"""The matcher's trees: one stage for all of them, the same for any dealing of the rows."""

import threading

import numpy as np

from kinmatch.functions.similarity import FEATURES
from kinmatch.operators import boosting, model


def sample(n, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4)).round(3)
    x[:, 3] = x[:, 3] > 0.5
    y = ((x[:, 0] > 0.6) & (x[:, 1] < 0.3) | (x[:, 2] > 0.95)).astype(float)
    return x, y, rng.integers(0, 2**63, n).astype(np.uint64)


def test_a_fit_takes_few_jobs(spark):
    """350 trees of depth 7 were a job for each level: over 2,000 jobs."""
    x, y, _ = sample(300)
    rows = [(f"S1-{k}", f"S2-{k}", float(y[k]), *[float(x[k, j % 4]) for j in range(len(FEATURES))]) for k in range(len(x))]
    df = spark.createDataFrame(rows, ["source1_entity_id", "candidate_entity_id", "label", *FEATURES])
    context = spark.sparkContext
    context.setJobGroup("few", "few")
    try:
        fitted = model.fit(df)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert fitted.feature.shape == (350, 127)
    assert 0 < len(context.statusTracker().getJobIdsForGroup("few")) <= 8
    got = {r["source1_entity_id"]: r["score"] for r in model.predict(df, fitted).collect()}
    assert all((got[f"S1-{k}"] > 0.5) == (y[k] == 1) for k in range(len(x)))


class Infos:
    """Stands for BarrierTaskContext in threads."""

    def __init__(self, tasks):
        self.n, self.notes, self.barrier = tasks, [""] * tasks, threading.Barrier(tasks)

    def of(self, rank):
        outer = self

        class Context:
            getTaskInfos = staticmethod(lambda: [type("I", (), {"address": "here:1"})] * outer.n)
            partitionId = staticmethod(lambda: rank)

            @staticmethod
            def allGather(note):
                outer.notes[rank] = note
                outer.barrier.wait(60)
                return outer.notes

        return Context


def dealt(x, y, key, tasks, trees, depth):
    infos, out = Infos(tasks), [None] * tasks

    def one(rank):
        peers = boosting.Peers(infos.of(rank))
        out[rank] = boosting.fit(x[rank::tasks], y[rank::tasks], key[rank::tasks], trees, depth, 42, peers)
        peers.close()

    threads = [threading.Thread(target=one, args=(k,)) for k in range(tasks)]
    [t.start() for t in threads]
    [t.join(120) for t in threads]
    return out[0]


def test_dealing_changes_nothing():
    x, y, key = sample(3000)
    one = dealt(x, y, key, 1, 8, 5)
    for tasks in (2, 5):
        other = dealt(x, y, key, tasks, 8, 5)
        for name in boosting.Trees.FIELDS:
            assert np.array_equal(getattr(one, name), getattr(other, name)), (tasks, name)
    assert np.array_equal(one.score(x), boosting.Trees.from_bytes(one.to_bytes()).score(x))


def test_against_plain_trees(monkeypatch):
    """All rows and features, at most 256 values each: as plain recursion over every cut finds."""
    monkeypatch.setattr(boosting, "ROW_SHARE", 1 - 1e-12)
    monkeypatch.setattr(boosting, "FEATURE_SHARE", 1.0)
    x, y, key = sample(400)
    x = np.floor(x * 50)
    made = dealt(x, y, key, 3, 6, 3)
    w = np.where(y == 1, max(1, (y == 0).sum() / (y == 1).sum()), 1.0)
    margin = np.zeros(len(x))

    def grow(rows, depth, g, h, step):
        value = lambda r: g[r].sum() ** 2 / (h[r].sum() + 1)
        best = (1e-6, None, None)
        for f in range(x.shape[1]) if depth else ():
            for c in np.unique(x[rows, f])[:-1]:
                a, b = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                if h[a].sum() >= 2 and h[b].sum() >= 2 and value(a) + value(b) - value(rows) > best[0] + 1e-9:
                    best = (value(a) + value(b) - value(rows), a, b)
        if best[1] is None:
            step[rows] = -0.05 * g[rows].sum() / (h[rows].sum() + 1)
        else:
            grow(best[1], depth - 1, g, h, step)
            grow(best[2], depth - 1, g, h, step)

    for _ in range(6):
        p, step = 1 / (1 + np.exp(-margin)), np.zeros(len(x))
        grow(np.arange(len(x)), 3, (p - y) * w, p * (1 - p) * w, step)
        margin += step
    assert np.abs(made.score(x) - 1 / (1 + np.exp(-margin))).max() < 1e-6


def test_odd_rows():
    x, y, key = sample(50)
    none = dealt(x[:0], y[:0], key[:0], 1, 2, 3)
    assert none.score(x).tolist() == [0.5] * 50 and none.score(x[:0]).tolist() == []
    x[0], x[1, 0] = np.nan, np.inf
    few = dealt(x, y, key, 4, 3, 2)
    assert np.isfinite(few.score(x)).all()
    assert len(set(dealt(x, y * 0, key, 2, 2, 2).score(x))) >= 1
