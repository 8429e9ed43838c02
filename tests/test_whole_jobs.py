"""Queries that do the whole of an operator, beside those that bound it."""

import os
from dataclasses import replace

import duckdb
import pytest

from kinmatch import schema as S
from kinmatch.functions import text as X
from kinmatch.operators import blocking, model, postings
from kinmatch.plans import registry
from kinmatch.plans.fixtures import Frames

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in os.listdir(SF):
        c.sql(f"create view {name.split('.')[0]} as select * from '{SF}/{name}'")
    return c


def same(spark, duck, name):
    df, want = registry.queries()[name](spark, SF), duck.sql(registry.oracle_sql()[name])
    rows = sorted(tuple(r) for r in df.select(*want.columns).collect())
    assert rows == sorted(want.fetchall())
    return rows


def test_token_pairs_beyond_the_five_longest(spark):
    def side(id_, address):
        return X.normalised(spark.createDataFrame([(id_, "n", address, "us")], "entity_id string, business_name string, business_address string, country string"))

    # "alfa" and "beta" are the two shortest of seven tokens, and the only ones in common
    a = side("S1-1", "alfa beta cccccc dddddd eeeeee ffffff gggggg")
    b = side("S2-1", "alfa beta hhhhhh iiiiii jjjjjj kkkkkk llllll")
    for most, n in ((5, 0), (None, 1)):
        s = replace(S.DEFAULT, rules=("B16",), pair_tokens=most)
        assert blocking.rule_pairs(blocking.keyed(a, s), blocking.keyed(b, s)).count() == n


def test_unbounded_token_pairs(spark, duck):
    rows = same(spark, duck, "b16_address_token_pairs")
    bounded = duck.sql(registry.oracle_sql()["b19_bounded_token_pairs"]).fetchall()
    assert sorted(set(rows)) != sorted(bounded)
    whole = same(spark, duck, "b17_unbounded_candidates")
    assert set(whole) >= {r for r in rows}


@pytest.mark.parametrize("name, fits", [("t05_boosted_trees", 1), ("t07_train_validate", 2)])
def test_matcher_queries_fit_the_production_model(spark, monkeypatch, name, fits):
    real, seen = model.fit, []

    def small(rows, trees=model.TREES, depth=7, seed=42):
        seen.append((trees, depth))
        return real(rows, 2, 2, seed)

    monkeypatch.setattr(model, "fit", small)
    assert registry.queries()[name](spark, SF.replace("0.01", "0.001")).count() > 0
    assert seen == [(350, 7)] * fits


def test_25_negatives_for_validation(spark, duck):
    assert len(same(spark, duck, "n03_validation_sampling")) > duck.sql(registry.oracle_sql()["n03_negative_sampling"]).count("label").fetchall()[0][0]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_of_candidates(spark):
    """Keys are made once a side, and the rank filter works before the shuffle."""
    f = Frames(spark, SF)
    plan = plan_of(f.candidates)
    assert "WindowGroupLimit" in plan and "documents.parquet" not in plan and "regexp" not in plan.lower()
    for side in blocking.keyed(f.s1), blocking.keyed(f.target):
        assert plan_of(side).count("FileScan") <= 2
    assert "WindowGroupLimit" in plan_of(blocking.best(blocking.evidence(f.pairs), 40))


def test_hot_keys_do_not_join(spark):
    """A key that is over its cap on one side takes no row to the pair join."""
    row = lambda id_, n: (id_, f"name{n} word", f"{n} street address", "us")
    columns = "entity_id string, business_name string, business_address string, country string"
    a = X.normalised(spark.createDataFrame([row(f"S1-{k}", 7) for k in range(5)], columns))
    b = X.normalised(spark.createDataFrame([row(f"S2-{k}", 7) for k in range(400)], columns))
    pairs = blocking.rule_pairs(*blocking.key_tables(a, b))
    assert pairs.count() == 0
    assert blocking.rule_pairs(*blocking.key_tables(a, b.limit(3))).where("rule = 'B01'").count() == 15


@pytest.mark.parametrize("part", [None, 40])
def test_candidates_beyond_the_cuts_of_postings(spark, duck, monkeypatch, part):
    if part:
        monkeypatch.setattr(postings, "PART", part)
        monkeypatch.setattr(postings, "CHUNK", 1000)
    whole = same(spark, duck, "m07_unbounded_candidates")
    cut = duck.sql(registry.oracle_sql()["m07_postings_candidates"]).fetchall()
    assert len(whole) == len(set(whole)) > len(cut) and set(whole) > set(cut)


def test_every_target_of_a_hot_key(spark):
    def side(rows):
        return X.normalised(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))

    a = side([("S1-1", "acme", "", "us"), ("S1-1", "", "12 road", "de"), ("S1-2", "zzz", "", "us"), ("S1-3", "acme", "", None)])
    b = side([(f"S2-{k}", "acme", "", "us") for k in range(700)] + [("S2-0", "", "12 road", "de"), ("S2-x", "", "", "us"), ("S2-y", "acme", "", "fr")])
    got = [tuple(r) for r in postings.every_candidate(a, b).collect()]
    assert sorted(got) == sorted(("S1-1", f"S2-{k}") for k in range(700))
    target = b.withColumn("pos", b.entity_id)
    assert postings.candidates(a, target, ["pos"]).distinct().count() == 250  # what the cuts leave of them
    empty = side([("S2-x", "", "", "us")])
    assert postings.every_candidate(a, empty).count() == postings.every_candidate(a.limit(0), b).count() == postings.every_candidate(a, b.limit(0)).count() == 0


def test_parts_that_spark_made_too_many_of(spark):
    many = spark.range(211).selectExpr("cast(id as int) as part")
    got = [r.part for r in postings._fewer(many, 6).orderBy("part").collect()]
    assert sorted(set(got)) == list(range(6)) and max(map(got.count, range(6))) <= 36
    assert postings._fewer(many, 211) is many and postings._fewer(many.limit(0), 1).count() == 0
