"""Recall and volume of blocking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as X
from . import blocking, features

#: Rules that are judged by their keys alone, whatever their frequencies.
BY_KEY = tuple(r.id for r in S.RULES if r.evidence)
OLD_FLAGS = (*[f"hit_{r.lower()}" for r in BY_KEY], "hit_fold_number", "hit_nameless_number")
NEW_FLAGS = ("hit_b15", "hit_b16")


def flagged(truth: DataFrame, s1: DataFrame, target: DataFrame, settings: S.Settings = S.DEFAULT) -> DataFrame:
    """True pairs with their country and a flag for each way in which they could be found.

    The ranked rules need a shared key that counts on the left; the two number flags compare
    the first address numbers of a pair; hit_b15 and hit_b16 obey the caps, as blocking does."""
    by_key = S.Settings(rules=BY_KEY)
    left = blocking.keyed(s1, by_key).where("counted").select(F.col("entity_id").alias(S.PAIR[0]), "rule", "key")
    right = blocking.keyed(target, by_key).select(F.col("entity_id").alias(S.PAIR[1]), "rule", "key")
    shared = truth.distinct().join(left, S.PAIR[0]).join(right, [S.PAIR[1], "rule", "key"])
    found = shared.groupBy(*S.PAIR).agg(F.collect_set("rule").alias("rules"))

    capped = S.Settings(rules=("B15", "B16"), pair_tokens=settings.pair_tokens)
    pairs = blocking.rule_pairs(*blocking.key_tables(s1, target, capped))
    later = pairs.join(truth.distinct(), list(S.PAIR), "left_semi").groupBy(*S.PAIR).agg(F.collect_set("rule").alias("later"))

    one, two = X.first_number(F.col("aa")), X.first_number(F.col("ba"))
    fold = lambda c: F.substring(F.replace(F.col(c), F.lit(" "), F.lit("")), 1, 4)
    number = (F.col("ac") == F.col("bc")) & (one != "") & (one == two)
    rows = features.hydrated(truth, s1, target).select(
        *S.PAIR, F.col("ac").alias("country"), (number & (fold("an") == fold("bn"))).alias("hit_fold_number"), (number & (F.col("bn") == "")).alias("hit_nameless_number")
    )
    rows = rows.join(found, list(S.PAIR), "left").join(later, list(S.PAIR), "left")
    has = lambda c, rule: F.coalesce(F.array_contains(c, rule), F.lit(False)).alias(f"hit_{rule.lower()}")
    numbers = [F.coalesce(c, F.lit(False)).alias(c) for c in OLD_FLAGS[-2:]]
    return rows.select(*S.PAIR, "country", *[has("rules", r) for r in BY_KEY], *numbers, *[has("later", r) for r in capped.rules])


def any_of(names) -> Column:
    return reduce(lambda a, b: a | b, [F.col(n) for n in names])


def recall_by_country(rows: DataFrame) -> DataFrame:
    old, new = any_of(OLD_FLAGS), any_of((*OLD_FLAGS, *NEW_FLAGS))
    pct = lambda c: F.round(F.count_if(c) * 100.0 / F.count(F.lit(1)), 4)
    return rows.groupBy("country").agg(
        F.count(F.lit(1)).alias("total_pairs"), F.count_if(old).alias("before_pairs"), pct(old).alias("before_pct"), F.count_if(new).alias("after_pairs"), pct(new).alias("after_pct")
    )


def missed(rows: DataFrame) -> DataFrame:
    return rows.where(~any_of((*OLD_FLAGS, *NEW_FLAGS)))


def attribution(rows: DataFrame) -> DataFrame:
    which = F.when(F.col("hit_b15") & F.col("hit_b16"), "both").when(F.col("hit_b15"), "B15").when(F.col("hit_b16"), "B16").otherwise("none")
    return rows.select(*S.PAIR, which.alias("rules"))


def volume(pairs: DataFrame, s1: DataFrame, target: DataFrame) -> DataFrame:
    """One row: pairs, entities, averages, coverage and the reduction of the comparison space."""
    p = pairs.agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("source1_entity_id").alias("active"))
    n = s1.agg(F.count(F.lit(1)).alias("n_s1")).join(target.agg(F.count(F.lit(1)).alias("n_target")))  # one row each
    return p.join(n).select(
        "pairs", "active", "n_s1", "n_target",
        F.round(F.col("pairs") / F.col("n_s1"), 6).alias("avg_all"), F.round(F.col("pairs") / F.greatest(F.lit(1), F.col("active")), 6).alias("avg_active"),
        F.round(F.col("active") * 100.0 / F.col("n_s1"), 4).alias("coverage_pct"), F.round(1 - F.col("pairs") / (F.col("n_s1") * F.col("n_target")), 6).alias("reduction"),
    )
