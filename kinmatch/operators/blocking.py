"""Candidate pairs by blocking rules with capped keys.

Each side becomes rows of (rule, key, entity_id, counted), written once, so that the regular
expressions of all rules run once a side. A key is live if its counted rows are at least one and
at most the cap on each capped side; only rows of live keys, on both sides, reach the pair join,
so it is no wider than the caps allow for counted rows, and ids alone travel through it.
Frequencies are partial aggregates, and what is joined on keys are plain scans, so that AQE can
split a key that very many rows have. Pairs of ranked rules and of the others are joined apart:
the best pairs of an entity are then a plain rank filter, which Spark applies to each partition
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as X
from ..workspace import written

_SEP = "\x01"


def _key(*parts: Column) -> Column:
    """Null if a part is null, so a null never matches."""
    return F.concat(*[p for k, x in enumerate(parts) for p in ((F.lit(_SEP), x) if k else (x,))])


def rule_keys(settings: S.Settings = S.DEFAULT) -> dict[str, Callable[[], Column]]:
    """For each rule what builds an array of (key, counted) over a normalised entity."""
    name, addr, country = F.col("name_norm"), F.col("address_norm"), F.col("country_norm")
    one = lambda key, counted: F.array(F.struct(key.alias("key"), counted.alias("counted")))
    many = lambda keys: F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(True).alias("counted")))
    if_ = lambda cond, keys: F.when(cond, keys).otherwise(F.array().cast("array<string>"))
    run5, run4 = F.regexp_extract(name, "[a-z]{5,}", 0), F.regexp_extract(addr, "[a-z]{4,}", 0)
    second = F.regexp_extract(name, "^[^ ]+ ([a-z]{4,})", 1)
    number = X.first_number(addr)
    tok2, long1 = F.get(X.name_tokens(name), F.lit(1)), F.get(X.address_tokens(addr), F.lit(0))
    both = (F.length(name) >= 3) & (F.length(addr) >= 4)
    return {
        "B01": lambda: one(_key(country, name), name != ""),
        "B02": lambda: one(name, name != ""),
        "B03": lambda: one(_key(country, addr), addr != ""),
        "B04": lambda: one(addr, addr != ""),
        "B05": lambda: one(_key(country, X.first_word(name, 3), X.first_word(addr, 4)), both),
        "B06": lambda: one(_key(X.first_word(name, 4), X.first_word(addr, 4)), (F.length(name) >= 4) & (F.length(addr) >= 4)),
        "B07": lambda: one(_key(country, X.first_word(name, 4)), F.length(name) >= 4),
        "B08": lambda: one(_key(country, run5), run5 != ""),
        "B09": lambda: one(_key(country, second), ~second.isin(*S.SECOND_WORD_STOPS)),
        "B10": lambda: one(_key(country, run4), run4 != ""),
        "B12": lambda: many(if_(tok2.isNotNull() & (number != ""), F.array(_key(country, tok2, number)))),
        "B13": lambda: many(if_((number != "") & (F.length(name) >= 4), F.array(_key(country, F.substring(F.replace(name, F.lit(" "), F.lit("")), 1, 4), number)))),
        "B14": lambda: many(if_(long1.isNotNull(), F.transform(X.numbers(addr, 1, 6), lambda n: _key(country, n, long1)))),
        "B15": lambda: many(F.transform(X.numbers(addr, 3, 8), lambda n: _key(country, n))),
        "B16": lambda: many(F.transform(X.let(X.address_words(addr, settings.pair_tokens), X.token_pairs), lambda p: _key(country, p["a"], p["b"]))),
    }


#: Expressions that were built, by the JVM that holds them: building the fifteen rules takes a
#: second of calls between Python and the JVM, for any input.
_built: dict[tuple, Column] = {}


def _key_rows(settings: S.Settings) -> Column:
    """All keys of an entity as an array of (rule, key, counted)."""
    jvm = SparkContext._active_spark_context._jvm
    at = (id(jvm), settings.rules, settings.pair_tokens)
    if at not in _built:
        per_rule = rule_keys(settings)
        tagged = lambda r: F.transform(per_rule[r](), lambda x: F.struct(F.lit(r).alias("rule"), x["key"].alias("key"), x["counted"].alias("counted")))
        _built[at] = F.flatten(F.array(*[tagged(r) for r in settings.rules]))
    return _built[at]


def keyed(entities: DataFrame, settings: S.Settings = S.DEFAULT) -> DataFrame:
    """Rows of (rule, key, entity_id, counted, nameless)."""
    rows = entities.select("entity_id", (F.coalesce("name_norm", F.lit("")) == "").alias("nameless"), F.explode(_key_rows(settings)).alias("x"))
    return rows.select("x.rule", "x.key", "entity_id", "x.counted", "nameless").where("key is not null")


def _cap(side: str) -> Column:
    caps = {r.id: r.cap_left if side == "left" else r.cap_right for r in S.RULES}
    return F.element_at(F.create_map(*[x for k, v in caps.items() for x in (F.lit(k), F.lit(v if v is not None else 2**62).cast("long"))]), F.col("rule"))


def frequencies(keys: DataFrame) -> DataFrame:
    return keys.groupBy("rule", "key").agg(F.count_if("counted").alias("n"))


def rule_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(rule, source1_entity_id, candidate_entity_id), one row per joined pair of key rows."""
    live_left = frequencies(left).where((F.col("n") >= 1) & (F.col("n") <= _cap("left"))).select("rule", "key")
    live_right = frequencies(right).where((F.col("n") >= 1) & (F.col("n") <= _cap("right"))).select("rule", "key")
    live = live_left.join(live_right, ["rule", "key"])
    a = left.select("rule", "key", F.col("entity_id").alias("source1_entity_id")).join(live, ["rule", "key"], "left_semi")
    b = right.where("rule <> 'B14' or nameless").select("rule", "key", F.col("entity_id").alias("candidate_entity_id")).join(live, ["rule", "key"], "left_semi")
    return a.join(b, ["rule", "key"]).select("rule", *S.PAIR)


def _evidence() -> Column:
    return F.element_at(F.create_map(*[x for r in S.RULES if r.evidence for x in (F.lit(r.id), F.lit(r.evidence).cast("long"))]), F.col("rule"))


RANKED = [r.id for r in S.RULES if r.evidence]


def evidence(pairs: DataFrame) -> DataFrame:
    """Evidence of ranked rules, summed per pair."""
    return pairs.where(F.col("rule").isin(*RANKED)).groupBy(*S.PAIR).agg(F.sum(_evidence()).alias("evidence"))


def best(scored: DataFrame, top: int, score: str = "evidence") -> DataFrame:
    """The `top` pairs of each source entity, ties by candidate id."""
    w = Window.partitionBy("source1_entity_id").orderBy(F.col(score).desc(), "candidate_entity_id")
    return scored.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= top)


def key_tables(s1: DataFrame, target: DataFrame, settings: S.Settings = S.DEFAULT) -> tuple[DataFrame, DataFrame]:
    """The key rows of both sides, written."""
    return written(keyed(s1, settings), "keys-left"), written(keyed(target, settings), "keys-right")


def chosen(left: DataFrame, right: DataFrame, top: int) -> DataFrame:
    """Distinct pairs of two key tables: the best of the ranked rules, and all of the others."""
    ranked = F.col("rule").isin(*RANKED)
    first = best(evidence(rule_pairs(left.where(ranked), right.where(ranked))), top).select(*S.PAIR)
    extra = rule_pairs(left.where(~ranked), right.where(~ranked)).select(*S.PAIR)
    return first.union(extra).distinct()


def candidates(s1: DataFrame, target: DataFrame, settings: S.Settings = S.DEFAULT) -> DataFrame:
    return chosen(*key_tables(s1, target, settings), settings.top)
