"""Blocking on literal entities."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kinmatch import schema as S
from kinmatch.functions import text as X
from kinmatch.operators import blocking, postings


def entities(spark, rows):
    return X.normalised(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))


def linked(spark, a, b, *rules):
    s = replace(S.DEFAULT, rules=rules)
    rows = blocking.rule_pairs(blocking.keyed(entities(spark, a), s), blocking.keyed(entities(spark, b), s)).collect()
    return {(r.rule, r.source1_entity_id, r.candidate_entity_id) for r in rows}


def test_null_country_links_only_rules_without_country(spark):
    a, b = [("S1-1", "acme tools", "12 long road", None)], [("S2-1", "acme tools", "12 long road", None)]
    assert {r for r, _, _ in linked(spark, a, b, *[r.id for r in S.RULES])} == {"B02", "B04", "B06"}


def test_counted_is_not_joined(spark):
    a = [("S1-1", "ab", "x", "us"), ("S1-2", "ab cd", "x", "us")]
    b = [("S2-1", "ab", "y", "us"), ("S2-2", "ab cd", "y", "us")]
    assert ("B07", "S1-1", "S2-1") in linked(spark, a, b, "B07")
    assert linked(spark, a[:1], b[:1], "B07") == set()


def test_cap_drops_a_key_on_either_side(spark):
    a = [("S1-1", "acme", "x", "us")]
    b = [(f"S2-{k}", "acme", "y", "us") for k in range(81)]
    assert linked(spark, a, b, "B02") == set()
    assert len(linked(spark, a, b[:80], "B02")) == 80
    assert len(linked(spark, a, b, "B01")) == 81


def test_nameless_rule(spark):
    a = [("S1-1", "acme", "12 orchard", "us")]
    b = [("S2-1", "", "012 orchard", "us"), ("S2-2", "other", "12 orchard", "us")]
    assert linked(spark, a, b, "B14") == {("B14", "S1-1", "S2-1")}


def test_top_and_ties(spark):
    rows = [("S1-1", f"S2-{k}", 10) for k in (9, 10, 2)] + [("S1-1", "S2-7", 11)]
    df = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, evidence long")
    assert [r.candidate_entity_id for r in blocking.best(df, 3).orderBy("rn").collect()] == ["S2-7", "S2-10", "S2-2"]


def test_extra_rules_are_not_capped_per_entity(spark):
    a = [("S1-1", "zzz", "12345 q", "us")]
    b = [(f"S2-{k:02}", f"n{k}", "12345 q", "us") for k in range(60)]
    got = blocking.candidates(entities(spark, a), entities(spark, b), replace(S.DEFAULT, rules=("B03", "B15"), top=5))
    assert got.count() == 60


def test_postings_are_cut_not_dropped(spark):
    a = [("S1-1", "acme", "", "us")]
    b = [(f"S2-{k}", "acme", "", "us") for k in range(9)]
    target = entities(spark, b).withColumn("pos", F.col("entity_id"))
    assert postings.candidates(entities(spark, a), target, ["pos"], replace(S.DEFAULT, max_postings=4)).count() == 4
    assert postings.candidates(entities(spark, a), target, ["pos"], replace(S.DEFAULT, max_per_entity=3)).count() == 3


@pytest.mark.parametrize("side", [0, 1])
def test_empty_side(spark, side):
    full = [("S1-1", "acme", "12 road", "us")]
    sides = [[], full] if side else [full, []]
    assert linked(spark, *sides, *[r.id for r in S.RULES]) == set()
