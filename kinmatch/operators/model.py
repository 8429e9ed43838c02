"""The matcher: gradient-boosted trees over the pair features (see `boosting`)."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.similarity import FEATURES
from ..workspace import discard, written
from . import boosting, evaluate, features, labeling

TREES = 350


#: Rows in a task while trees are fitted: few rows in many tasks only slow the exchange down.
ROWS = 20_000


def balance(rows: DataFrame) -> tuple[float, int]:
    """max(1, negatives / positives), and the partitions that the rows need."""
    n = rows.agg(F.count_if(F.col("label") == 0).alias("neg"), F.count_if(F.col("label") == 1).alias("pos")).first()
    return max(1.0, n["neg"] / max(1, n["pos"])), 1 + (n["neg"] + n["pos"]) // ROWS


def positive_weight(rows: DataFrame) -> float:
    return balance(rows)[0]


def _slots(spark: SparkSession) -> int:
    """Tasks that can run at once, which a barrier stage needs."""
    context = spark.sparkContext._jsc.sc()
    return max(1, min(spark.sparkContext.defaultParallelism, context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())))


def fit(rows: DataFrame, trees: int = TREES, depth: int = 7, seed: int = 42) -> boosting.Trees:
    """The rows are written once, as they are read twice; then all trees are one stage."""
    ids = [c for c in S.PAIR if c in rows.columns] or FEATURES
    made = written(rows.select(*[F.col(c).cast("double") for c in FEATURES], F.col("label").cast("double"), F.xxhash64(*ids).alias("key")), "training")
    try:
        tasks = min(balance(made)[1], _slots(rows.sparkSession))
        found = made.repartition(tasks).mapInArrow(boosting.stage(FEATURES, trees, depth, seed), "model binary", barrier=True).collect()  # a row
        return boosting.Trees.from_bytes(bytes(found[0]["model"]))
    finally:
        discard(made)


def predict(rows: DataFrame, model: boosting.Trees) -> DataFrame:
    """The rows and `score`, the probability of a match."""
    shared = rows.sparkSession.sparkContext.broadcast(model.to_bytes())
    # not deterministic only in name: a filter on the score would else compute it a second time
    score = F.pandas_udf(boosting.scores(shared), "double").asNondeterministic()
    return rows.withColumn("score", score(*[F.col(c).cast("double") for c in FEATURES]))


Scorer = Callable[[DataFrame], DataFrame]


def scorer(model: boosting.Trees) -> Scorer:
    return lambda rows: predict(rows, model)


def score_candidates(pairs: DataFrame, s1: DataFrame, target: DataFrame, by: Scorer) -> DataFrame:
    """Candidate pairs with their features and score, by a fitted model or another scorer."""
    return by(features.make_features(pairs, s1, target))


def score_entities(pairs: DataFrame, ids: DataFrame, s1: DataFrame, target: DataFrame, by: Scorer, threshold: float) -> DataFrame:
    """The selected pairs of some source entities (`ids` has one column, entity_id): their
    candidates alone are hydrated and scored."""
    own = pairs.join(ids.select(F.col("entity_id").alias("source1_entity_id")).distinct(), "source1_entity_id", "left_semi")
    return score_candidates(own.select("source1_entity_id", "candidate_entity_id"), s1, target, by).where(F.col("score") >= threshold)


def train_validate(rows: DataFrame, thresholds, trees: int = TREES, folds: int = 5, negatives: int = 20, refit: bool = True):
    """Splits by source entity, fits, tunes the threshold and, if asked, fits again on all rows.
    Returns the model, the threshold and the measures of each threshold on the held-out part."""
    rows = rows.withColumn("part", labeling.bucket("source1_entity_id", folds)).persist()
    try:
        train = labeling.first_negatives(rows.where("part > 0"), negatives)
        model = fit(train, trees)
        measured = evaluate.measures(evaluate.confusion(predict(rows.where("part = 0"), model), thresholds)).collect()  # a row per threshold
        best = max(measured, key=lambda r: (r["f05"], r["precision"], r["threshold"]))
        return (fit(labeling.first_negatives(rows, negatives), trees) if refit else model), best["threshold"], measured
    finally:
        rows.unpersist()


def save(model: boosting.Trees, path: str, threshold: float) -> None:
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(bytearray(model.to_bytes()),)], "model binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    note = json.dumps({"threshold": threshold, "feature_columns": FEATURES})
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")


def load(spark: SparkSession, path: str) -> tuple[boosting.Trees, dict]:
    model = spark.read.schema("model binary").parquet(f"{path}/model").first()["model"]
    return boosting.Trees.from_bytes(bytes(model)), json.loads(spark.read.text(f"{path}/settings").first()[0])
