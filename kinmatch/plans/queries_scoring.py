"""Queries on features, samples, thresholds and the matcher."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.similarity import FEATURES, rounded
from ..operators import evaluate, features, labeling, model
from ..workspace import folder, written
from .registry import query
from .sql import over

PAIRS = "source1_entity_id, candidate_entity_id"
T8 = S.DEFAULT.thresholds
FINE = S.DEFAULT.fine
LOW = tuple(round(0.1 * k, 1) for k in range(1, 10))


def _rounded(*columns):
    return lambda f: f.features.select(*S.PAIR, *[F.round(F.col(c).cast("double"), 6).alias(c) for c in columns])


def _sql_rounded(*columns):
    return over("feat", f"select {PAIRS}, " + ", ".join(f"round({c}::double, 6) as {c}" for c in columns) + " from feat")


_BY = {
    "p01_exact": "exact", "p02_char_jaccard": "char_jaccard", "p03_token_jaccard": "token_jaccard", "p04_token_containment": "token_containment", "p05_tfidf_cosine": "tfidf_cosine",
    "p06_number_overlap": "number_overlap", "p07_edit": "edit", "p08_length_delta": "length_delta",
}
for _name, _f in _BY.items():
    query(_name, _sql_rounded(f"name_{_f}", f"address_{_f}"))(_rounded(f"name_{_f}", f"address_{_f}"))
query("p09_missing", _sql_rounded("name_missing_a", "name_missing_b", "address_missing_a", "address_missing_b"))(_rounded("name_missing_a", "name_missing_b", "address_missing_a", "address_missing_b"))
query("p10_country_exact", _sql_rounded("country_exact"))(_rounded("country_exact"))
query("p11_combined_similarity", over("feat", f"select {PAIRS}, round(combined_similarity, 6) as combined_similarity, round((name_char_jaccard + name_token_jaccard) / 2, 6) as combined_char from feat"))(
    lambda f: f.features.select(*S.PAIR, F.round("combined_similarity", 6).alias("combined_similarity"), F.round((F.col("name_char_jaccard") + F.col("name_token_jaccard")) / 2, 6).alias("combined_char"))
)
query("p12_all_features", _sql_rounded(*FEATURES))(_rounded(*FEATURES))
query("f19_column_alignment", over("feat", f"select {PAIRS}, round(name_edit, 6) as name_edit, 0.0::double as address_edit from feat"))(
    lambda f: features.aligned(f.features.select(*S.PAIR, "name_edit"), ["name_edit", "address_edit"]).withColumn("name_edit", F.round("name_edit", 6))
)

# --- truth, samples, splits -------------------------------------------------------------------

query("t01_parse_truth", over("candidates", f"select distinct {PAIRS} from truth"))(
    lambda f: labeling.truth_pairs(f.truth.groupBy("source1_entity_id").agg(F.array_join(F.collect_list("candidate_entity_id"), ",").alias("matched_entity_ids")))
)
query("t02_label_candidates", over("labelled", f"select {PAIRS}, label from labelled where label = 1"))(lambda f: f.labelled.where("label = 1").select(*S.PAIR, "label"))
_NEG = "select {p}, label from (select *, row_number() over (partition by source1_entity_id, label order by {o}) as rn from labelled) where label = 1 or rn <= {n}"
query("t03_balanced_candidates", over("labelled", _NEG.format(p=PAIRS, o="candidate_entity_id", n=20)))(lambda f: labeling.first_negatives(f.labelled, 20).select(*S.PAIR, "label"))
query("n03_negative_sampling", over("labelled", _NEG.format(p=PAIRS, o="md5(candidate_entity_id)", n=15)))(lambda f: labeling.with_negatives(f.labelled, 15).select(*S.PAIR, "label"))
query("n03_validation_sampling", over("labelled", _NEG.format(p=PAIRS, o="md5(candidate_entity_id)", n=25)))(lambda f: labeling.with_negatives(f.labelled, S.DEFAULT.valid_negatives).select(*S.PAIR, "label"))
query("n08_first_negatives", over("labelled", _NEG.format(p=PAIRS, o="candidate_entity_id", n=20)))(lambda f: labeling.first_negatives(f.labelled, 20).select(*S.PAIR, "label"))
query("t04_entity_split", over("labelled", f"select {PAIRS}, label, ('0x' || substr(md5(source1_entity_id), 1, 7))::bigint % 5 = 0 as held_out from labelled"))(
    lambda f: f.labelled.select(*S.PAIR, "label", (labeling.bucket("source1_entity_id", 5) == 0).alias("held_out"))
)
query("t06_positive_weight", over("labelled", "select greatest(1.0, round(count(*) filter (label = 0)::double / greatest(1, count(*) filter (label = 1)), 6)) as weight from labelled"))(
    lambda f: f.labelled.agg(F.greatest(F.lit(1.0), F.round(F.count_if(F.col("label") == 0) / F.greatest(F.lit(1), F.count_if(F.col("label") == 1)), 6)).alias("weight"))
)

# --- thresholds ------------------------------------------------------------------------------


def _counts(thresholds, by: str = "") -> str:
    values = ", ".join(f"({float(t)!r}::double)" for t in thresholds)
    head = f"{by}, " if by else ""
    return (
        f"cf as (select {head}t as threshold, count(*) filter (score >= t and label = 1) as tp, count(*) filter (score >= t and label = 0) as fp, count(*) filter (score < t and label = 1) as fn from pool, (values {values}) v(t) group by {head}t),\n"
        "m0 as (select *, case when tp + fp = 0 then 0.0 else tp::double / (tp + fp) end as precision, case when tp + fn = 0 then 0.0 else tp::double / (tp + fn) end as recall from cf),\n"
        "m as (select *, case when precision + recall = 0 then 0.0 else 1.25 * precision * recall / (0.25 * precision + recall) end as f05 from m0)"
    )


POOL = "pool as (select * from scored)"
_R = "threshold, tp, fp, fn, round(precision, 6) as precision, round(recall, 6) as recall, round(f05, 6) as f05"


def _shown(df, *by):
    return df.select(*by, "threshold", "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f05")])


query("w06_threshold", over("scored", f"select {PAIRS}, score from scored where score >= 0.5"))(lambda f: f.scored.where("score >= 0.5").select(*S.PAIR, "score"))
query("a09_score_stats", over("scored", "select count(*) as n, round(sum(score), 4) as sum, min(score) as min, max(score) as max, " + ", ".join(f"count(*) filter (score >= {t}) as ge_{int(round(t * 100))}" for t in T8) + " from scored"))(
    lambda f: evaluate.score_stats(f.scored, T8).withColumn("sum", F.round("sum", 4))
)
query("a15_confusion", over("scored", "select threshold, tp, fp, fn from m", POOL, _counts(LOW)))(lambda f: evaluate.confusion(f.scored, LOW))
query("t10_f05", over("scored", f"select {_R} from m", POOL, _counts((0.5,))))(lambda f: _shown(evaluate.measures(evaluate.confusion(f.scored, (0.5,)))))
query("t11_threshold_grid", over("scored", f"select {_R} from m", POOL, _counts(T8)))(lambda f: _shown(evaluate.measures(evaluate.confusion(f.scored, T8))))
query("t11_tuned_threshold", over("scored", f"select {_R} from m order by m.f05 desc, m.precision desc, threshold desc limit 1", POOL, _counts(T8)))(lambda f: _shown(evaluate.tuned(evaluate.measures(evaluate.confusion(f.scored, T8)))))
query(
    "t12_fine_grid",
    over(
        "scored",
        f"select {_R}, round(tp::double / (select count(*) from truth), 6) as full_recall from m",
        POOL,
        _counts(FINE),
    ),
)(
    lambda f: evaluate.measures(evaluate.confusion(f.scored, FINE).join(f.truth.agg(F.count(F.lit(1)).alias("total"))), F.col("total")).select(
        "threshold", "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f05", "full_recall")]
    )
)
query("t13_best_and_fixed", over("scored", f"(select 'best' as which, {_R} from m order by m.f05 desc, m.precision desc, threshold desc limit 1) union all select 'fixed', {_R} from m where threshold = 0.97", POOL, _counts(FINE)))(
    lambda f: _shown(evaluate.tuned(m := evaluate.measures(evaluate.confusion(f.scored, FINE))).withColumn("which", F.lit("best")), "which").union(_shown(m.where("threshold = 0.97").withColumn("which", F.lit("fixed")), "which"))
)
_POOLS = "pool as (select *, 'after' as pool from scored union all select s.*, 'before' from scored s where score >= 0.2)"
query("t14_pool_comparison", over("scored", f"select pool, {_R} from m", _POOLS, _counts((0.92, 0.97), "pool")))(
    lambda f: _shown(evaluate.measures(evaluate.confusion((sc := f.scored).withColumn("pool", F.lit("after")).union(sc.where("score >= 0.2").withColumn("pool", F.lit("before"))), (0.92, 0.97), "pool")), "pool")
)
query(
    "t15_classification_report",
    over(
        "scored",
        "select class, round(p, 6) as precision, round(r, 6) as recall, round(case when p + r = 0 then 0.0 else 2 * p * r / (p + r) end, 6) as f1, support from (select c as class, coalesce(count(*) filter (pred = c and label = c)::double / nullif(count(*) filter (pred = c), 0), 0.0) as p, coalesce(count(*) filter (pred = c and label = c)::double / nullif(count(*) filter (label = c), 0), 0.0) as r, count(*) filter (label = c) as support from (select label, case when score >= 0.5 then 1 else 0 end as pred from scored), (values (0), (1)) v(c) group by c)",
    ),
)(lambda f: evaluate.report(f.scored, 0.5).select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support"))
query("a11_any_per_entity", over("scored", "select source1_entity_id, bool_or(score >= 0.5) as matched, bool_or(label = 1) as true_match from scored group by 1"))(
    lambda f: f.scored.groupBy("source1_entity_id").agg(F.bool_or(F.col("score") >= 0.5).alias("matched"), F.bool_or(F.col("label") == 1).alias("true_match"))
)
_GUARDED = (0.3, 0.5, 0.9, 1.5)


@query("t16_selection_guard", over("scored", f"select t as threshold, e as emptied, e and (select count(*) from scored where score >= t) > 0 as refused from (values {', '.join(f'({t}::double)' for t in _GUARDED)}) v(t), (values (true), (false)) w(e)"))
def _guarded(f):
    """Exports with and without their selection: the guard refuses an empty one if scores qualify."""
    scored, rows = written(f.scored, "scored"), []
    for t in _GUARDED:
        for emptied in (True, False):
            selected = scored.where(F.lit(False) if emptied else F.col("score") >= t)
            try:
                evaluate.guard(selected, scored, t)
                rows.append((t, emptied, False))
            except evaluate.EmptySelection:
                rows.append((t, emptied, True))
    return f.spark.createDataFrame(rows, "threshold double, emptied boolean, refused boolean")


def _by_rule(rows):
    """A scorer that any engine gives alike, in the place of a fitted model."""
    return rows.withColumn("score", rounded((F.col("name_char_jaccard") + F.col("address_char_jaccard")) / 2, 6))


query("t08_predict_candidates", over("scored", f"select {PAIRS}, score from scored"))(lambda f: model.score_candidates(f.candidates, f.s1, f.target, _by_rule).select(*S.PAIR, "score"))
query("t09_score_entities", over("scored", f"select {PAIRS}, score from scored where score >= 0.4 and source1_entity_id in (select entity_id from s1 order by md5(entity_id), entity_id limit 200)"))(
    lambda f: model.score_entities(f.candidates, labeling.sample(f.s1, 200).select("entity_id"), f.s1, f.target, _by_rule, 0.4).select(*S.PAIR, "score")
)

# --- the matcher: boosted trees have no SQL, so rows alone are compared -----------------------


@query("k09_model_round_trip", over("scored", "select count(*) as pairs, 0::bigint as differing, true as same_columns from scored"))
def _round_trip(f):
    """A matcher of few trees, written and loaded: both score all pairs alike."""
    rows, path = written(f.features.withColumn("label", F.col("label").cast("double")), "k09-rows"), folder(f.spark, "k09")
    fitted = model.fit(rows, trees=3)
    model.save(fitted, path, 0.97)
    loaded, note = model.load(f.spark, path)
    scores = [model.predict(rows, m).select(*S.PAIR, F.col("score").alias(c)) for m, c in ((fitted, "a"), (loaded, "b"))]
    both = scores[0].join(scores[1], list(S.PAIR))
    return both.agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("a") != F.col("b")).alias("differing")).withColumn("same_columns", F.lit(note["feature_columns"] == FEATURES))


@query("t05_boosted_trees")
def _trees(f):
    rows = written(f.features, "t05-rows")
    fitted = model.fit(labeling.with_negatives(rows.withColumn("label", F.col("label").cast("double")), 15))
    return model.predict(rows, fitted).select(*S.PAIR, "label", F.round("score", 6).alias("score"))


@query("t07_train_validate")
def _train(f):
    _, threshold, measured = model.train_validate(f.features.withColumn("label", F.col("label").cast("double")), T8)
    rows = [(float(r["threshold"]), r["tp"], r["fp"], r["fn"], float(r["f05"]), r["threshold"] == threshold) for r in measured]
    return f.spark.createDataFrame(rows, "threshold double, tp long, fp long, fn long, f05 double, chosen boolean")


