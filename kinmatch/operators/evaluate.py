"""Thresholds, confusion counts and score statistics, each in one pass over the scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def f05(p: Column, r: Column) -> Column:
    return F.when(p + r == 0, F.lit(0.0)).otherwise(1.25 * p * r / (0.25 * p + r))


def confusion(scored: DataFrame, thresholds, *by: str, score: str = "score", label: str = "label") -> DataFrame:
    """tp, fp and fn for each threshold (and group): conditional counts, not copies of rows."""
    hit, pos = (lambda t: F.col(score) >= F.lit(float(t))), F.col(label) == 1
    aggs = []
    for k, t in enumerate(thresholds):
        aggs += [F.count_if(hit(t) & pos).alias(f"tp{k}"), F.count_if(hit(t) & ~pos).alias(f"fp{k}"), F.count_if(~hit(t) & pos).alias(f"fn{k}")]
    parts = [F.struct(F.lit(float(t)).alias("threshold"), *[F.col(f"{x}{k}").alias(x) for x in ("tp", "fp", "fn")]) for k, t in enumerate(thresholds)]
    grouped = scored.groupBy(*by) if by else scored
    return grouped.agg(*aggs).select(*by, F.explode(F.array(*parts)).alias("x")).select(*by, "x.*")


def measures(counts: DataFrame, total: Column | None = None) -> DataFrame:
    """precision, recall and f05 of confusion rows; with `total`, recall against it as well."""
    tp = F.col("tp")
    out = counts.withColumns({"precision": ratio(tp, tp + F.col("fp")), "recall": ratio(tp, tp + F.col("fn"))})
    out = out.withColumn("f05", f05(F.col("precision"), F.col("recall")))
    if total is not None:
        out = out.withColumn("full_recall", ratio(tp, total))
        out = out.withColumn("full_f05", f05(F.col("precision"), F.col("full_recall")))
    return out


def tuned(measured: DataFrame, *by: str) -> DataFrame:
    """The row of the best f05, then precision, then threshold, as `best` of `by` groups."""
    key = F.struct("f05", "precision", "threshold", "recall", "tp", "fp", "fn")
    grouped = measured.groupBy(*by) if by else measured
    return grouped.agg(F.max(key).alias("best")).select(*by, "best.*")


def score_stats(scored: DataFrame, cuts, score: str = "score") -> DataFrame:
    s = F.col(score)
    return scored.agg(F.count(s).alias("n"), F.sum(s).alias("sum"), F.min(s).alias("min"), F.max(s).alias("max"), *[F.count_if(s >= c).alias(f"ge_{int(round(c * 100))}") for c in cuts])


def report(scored: DataFrame, threshold: float, score: str = "score", label: str = "label") -> DataFrame:
    """Precision, recall, F1 and support of either class, a row each."""
    counts = confusion(scored, [threshold], score=score, label=label).join(scored.agg(F.count(F.lit(1)).alias("n")))
    tn = F.col("n") - F.col("tp") - F.col("fp") - F.col("fn")
    rows = [(1, F.col("tp"), F.col("fp"), F.col("fn")), (0, tn, F.col("fn"), F.col("fp"))]
    parts = []
    for c, right, wrong, missed in rows:
        p, r = ratio(right, right + wrong), ratio(right, right + missed)
        parts.append(F.struct(F.lit(c).alias("class"), p.alias("precision"), r.alias("recall"), F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r)).alias("f1"), (right + missed).alias("support")))
    return counts.select(F.explode(F.array(*parts)).alias("x")).select("x.*")


class EmptySelection(RuntimeError):
    """Scores reached the threshold, but no pair was selected."""


def guard(selected: DataFrame, scored: DataFrame, threshold: float, score: str = "score") -> None:
    if not selected.limit(1).count() and scored.where(F.col(score) >= threshold).limit(1).count():
        raise EmptySelection(f"no pair selected although scores reach {threshold}")
