"""Truth, labels, samples and splits. Every order is by md5, so results don't vary by engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S


def truth_pairs(wide: DataFrame) -> DataFrame:
    """Distinct pairs of a (source1_entity_id, matched_entity_ids) table; singletons have none."""
    ids = F.explode(F.split("matched_entity_ids", ","))
    return wide.select("source1_entity_id", ids.alias("candidate_entity_id")).where("candidate_entity_id <> ''").distinct()


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    marked = truth.select(*S.PAIR).distinct().withColumn("hit", F.lit(1))
    return pairs.join(marked, list(S.PAIR), "left").withColumn("label", F.coalesce("hit", F.lit(0))).drop("hit")


def by_hash(c: str) -> Column:
    return F.md5(F.col(c))


def with_negatives(pairs: DataFrame, most: int) -> DataFrame:
    """All positives and at most `most` negatives of each source entity, in md5 order."""
    w = Window.partitionBy("source1_entity_id", "label").orderBy(by_hash("candidate_entity_id"))
    return pairs.withColumn("rn", F.row_number().over(w)).where((F.col("label") == 1) | (F.col("rn") <= most)).drop("rn")


def first_negatives(pairs: DataFrame, most: int, order: str = "candidate_entity_id") -> DataFrame:
    """All positives and the first `most` negatives of each source entity in the order given."""
    w = Window.partitionBy("source1_entity_id", "label").orderBy(order)
    return pairs.withColumn("rn", F.row_number().over(w)).where((F.col("label") == 1) | (F.col("rn") <= most)).drop("rn")


def stratified(df: DataFrame, share: float, by: str = "country_norm", id_: str = "entity_id") -> DataFrame:
    """ceil(share * n) rows of each group, in md5 order."""
    w = Window.partitionBy(by)
    ranked = df.withColumns({"rn": F.row_number().over(w.orderBy(by_hash(id_))), "cnt": F.count(F.lit(1)).over(w)})
    return ranked.where(F.col("rn") <= F.ceil(F.col("cnt") * share)).drop("rn", "cnt")


def per_group(df: DataFrame, most: int, by: str = "country_norm", id_: str = "entity_id") -> DataFrame:
    w = Window.partitionBy(by).orderBy(by_hash(id_))
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most).drop("rn")


def sample(df: DataFrame, n: int, id_: str = "entity_id") -> DataFrame:
    return df.orderBy(by_hash(id_), id_).limit(n)


def folds(sampled: DataFrame, k: int = 5, id_: str = "entity_id") -> DataFrame:
    """(entity_id, split): ranks modulo k over a bounded sample, so one task ranks it."""
    w = Window.orderBy(by_hash(id_), id_)
    return sampled.select(id_, (F.row_number().over(w) % k).cast("long").alias("split"))


def bucket(id_: str, buckets: int) -> Column:
    """A split that needs no ranks: whole entities stay together at any size."""
    return (F.conv(F.substring(F.md5(F.col(id_)), 1, 7), 16, 10).cast("long") % buckets).cast("long")
