"""The second blocker deals source entities to parts; pairs are not shuffled."""

import os
from dataclasses import replace

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinmatch import schema as S
from kinmatch.operators import postings
from kinmatch.plans import registry
from kinmatch.plans.fixtures import Frames

SF = "/root/testdata/sf0.001"
ORDER = ["src", "doc_id"]


@pytest.mark.parametrize("name", ["m06_weighted_score", "m07_postings_candidates", "n07_top_300_by_position"])
def test_many_parts_and_chunks_make_the_same_pairs(spark, monkeypatch, name):
    monkeypatch.setattr(postings, "PART", 3)
    monkeypatch.setattr(postings, "CHUNK", 70)
    c = duckdb.connect()
    for table in os.listdir(SF):
        c.sql(f"create view {table.split('.')[0]} as select * from '{SF}/{table}'")
    want = c.sql(registry.oracle_sql()[name])
    df = registry.queries()[name](spark, SF)
    assert sorted(tuple(r) for r in df.select(*want.columns).collect()) == sorted(want.fetchall())


@pytest.mark.parametrize("of", [lambda f: postings.scored(f.s1, f.target, ORDER), lambda f: postings.candidates(f.s1, f.target, ORDER)])
def test_pairs_are_not_shuffled(spark, of):
    plan = of(Frames(spark, SF))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("MapInArrow", 1)
    assert "Exchange" not in above and "Aggregate" not in above
    assert "candidate_entity_id" not in below.split("\n", 1)[1]


def test_the_best_by_score_then_position(spark):
    f = Frames(spark, SF)
    every = postings.scored(f.s1, f.target, ORDER).collect()
    of = {}
    for r in every:
        of.setdefault(r["source1_entity_id"], []).append((-r["score"], r["position"], r["candidate_entity_id"]))
    want = sorted((s, x[2]) for s, rows in of.items() for x in sorted(rows)[:7])
    got = postings.candidates(f.s1, f.target, ORDER, replace(S.DEFAULT, max_per_entity=7)).collect()
    assert sorted(tuple(r) for r in got) == want


def test_lists_whose_first_hashes_are_alike():
    long = lambda *v: pa.array([[x] for x in v], pa.list_(pa.int64()))
    part = postings._Part([pa.RecordBatch.from_pydict({"h1": long(5, 5, 9, 5), "h2": long(7, 1, 2, 3), "w": pa.array([1, 2, 3, 4]), "ns": long(0, 1, 2, 3), "ids": pa.array([["a"], ["b"], ["c"], ["d"]])})])
    found = part.find(np.array([5, 5, 5, 5, 9, 9, 4, 10]), np.array([7, 1, 3, 8, 2, 1, 7, 2]))
    assert [int(part.w[k]) if k >= 0 else None for k in found] == [1, 2, 4, None, 3, None, None, None]


def test_repeated_rows_count_once(spark):
    f = Frames(spark, SF)
    once = postings.scored(f.s1, f.target, ORDER).drop("position")
    twice = postings.scored(f.s1.union(f.s1), f.target.union(f.target), ORDER).drop("position")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert postings.scored(f.s1.limit(0), f.target, ORDER).count() == postings.scored(f.s1, f.target.limit(0), ORDER).count() == 0


def test_few_parts_get_a_list(spark, monkeypatch):
    """A list travels once for each part that needs it."""

    def lists(batches, top):
        for b in batches:
            part, lone = b.column("part").to_numpy(), b.column("entity_id").is_null().to_numpy(zero_copy_only=False)
            for p in np.unique(part).tolist():
                mine = (part == p) & lone
                size = b.column("ns").filter(pa.array(mine)).value_lengths().sum().as_py() or 0
                yield pa.RecordBatch.from_arrays([pa.array([str(p)]), pa.array([""]), pa.array([int(mine.sum())]), pa.array([size])], ["source1_entity_id", "candidate_entity_id", "position", "score"])

    monkeypatch.setattr(postings, "PART", 20)
    monkeypatch.setattr(postings, "_pairs", lists)
    f = Frames(spark, "/root/testdata/sf0.01")
    rows = postings.scored(f.s1, f.target, ORDER).collect()
    assert len({r["source1_entity_id"] for r in rows}) > 10
    assert sum(r["score"] for r in rows) < 120_000  # postings that travel; 169,598 if parts are dealt by a hash


def test_tables_hold_no_keys(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(postings, "written", lambda df, name, f=postings.written: tables.append(f(df, name)) or tables[-1])
    f = Frames(spark, SF)
    postings.candidates(f.s1, f.target, ORDER)
    wide = lambda t: [c for c, kind in t.dtypes if "key" in kind or "h1" in kind or c in ("key", "keys", "k")]
    assert tables and not [wide(t) for t in tables if wide(t)]


def test_all_rows_of_an_entity_are_in_one_part(spark, monkeypatch):
    monkeypatch.setattr(postings, "PART", 3)
    f = Frames(spark, SF)
    other = f.s1.withColumn("name_norm", F.reverse("name_norm"))
    pairs = postings.scored(f.s1.union(other), f.target, ORDER).select(*S.PAIR).collect()
    assert len(pairs) == len(set(pairs)) >= postings.scored(f.s1, f.target, ORDER).count()
