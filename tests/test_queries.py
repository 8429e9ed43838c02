"""All registered queries that have SQL, against it, on the smallest tables.

They share one set of frames, whose stages are computed once."""

import math
import os

import duckdb
import pytest

from kinmatch.plans import registry
from kinmatch.plans.fixtures import Frames

SF = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()
SHARED = ("entities", "s1", "s2", "s3", "target", "truth", "pairs", "candidates", "labelled", "features", "scored")


def test_each_sql_has_a_query():
    assert set(SQL) <= set(registry.queries()) and len(SQL) > 170
    assert set(registry.queries()) - set(SQL) == {"t05_boosted_trees", "t07_train_validate"}


@pytest.fixture(scope="module")
def frames(spark):
    f = Frames(spark, SF)
    for name in SHARED:
        f.__dict__[name] = getattr(f, name).persist()
    yield f
    for name in SHARED:
        f.__dict__[name].unpersist()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in os.listdir(SF):
        c.sql(f"create view {name.split('.')[0]} as select * from '{SF}/{name}'")
    return c


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    clean = lambda x: None if isinstance(x, float) and math.isnan(x) else x
    return sorted(tuple(repr(clean(r[k])) for k in order) for r in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(frames, duck, name):
    df = registry.functions()[name](frames)
    got = [tuple(r) for r in df.collect()]
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, got) == rows(want.columns, want.fetchall())


def test_flagship(spark):
    assert registry.flagship(spark, SF).columns == ["source1_entity_id", "candidate_entity_id"]
