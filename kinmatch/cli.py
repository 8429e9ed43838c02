"""Command line: python -m kinmatch.cli train | infer | validate."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import schema as S
from .functions import text as X
from .operators import labeling, model
from .plans import pipeline
from .sources import delimited, validate


def _sources(spark: SparkSession, folder: str, stem: str):
    """Normalised source 1 and targets; nulls are kept for countries."""
    one, two, three = (X.normalised(delimited.read_tsv(spark, f"{folder}/{stem}_source{k}.tsv")) for k in (1, 2, 3))
    return one, two.unionByName(three)


def train(spark: SparkSession, a: argparse.Namespace) -> int:
    s1, target = _sources(spark, a.data, "train")
    truth = labeling.truth_pairs(delimited.read_tsv(spark, f"{a.data}/train_ground_truth.tsv", S.TRUTH))
    print("threshold", pipeline.train(spark, s1, target, truth, a.out, sample=a.sample, trees=a.trees))
    return 0


def infer(spark: SparkSession, a: argparse.Namespace) -> int:
    """Refuses to start without its inputs and a finished matcher, or in a folder of a run with
    other settings; finished stages are not run again."""
    try:
        pipeline.preflight(spark, [f"{a.data}/test_source{k}.tsv" for k in (1, 2, 3)], [f"{a.model}/matcher/settings"])
    except FileNotFoundError as e:
        print(e, file=sys.stderr)
        return 1
    s1, target = _sources(spark, a.data, "test")
    fitted, note = model.load(spark, f"{a.model}/matcher")
    settings = S.Settings(threshold=a.threshold if a.threshold is not None else note["threshold"])
    selected = pipeline.link(spark, s1, target, model.scorer(fitted), a.out, settings)
    print("selected", selected.count())
    return 0


def check(spark: SparkSession, a: argparse.Namespace) -> int:
    """0 if the two result files have no errors, else 1; warnings don't count."""
    try:
        required = delimited.read_ids(spark, f"{a.data}/test_source1.tsv")
        known = delimited.read_ids(spark, f"{a.data}/test_source2.tsv").union(delimited.read_ids(spark, f"{a.data}/test_source3.tsv")) if a.check_ids else None
        errors, warnings = validate.validate(spark, a.matching, a.candidate, required, known)
        found = validate.summary(errors).withColumn("kind", F.lit("error")).union(validate.summary(warnings).withColumn("kind", F.lit("warning"))).collect()
    except Exception as e:  # a file that can't be read is a finding of its own
        print(f"error: {e}", file=sys.stderr)
        return 1
    for r in found:
        print(f"{r['kind']}: {r['finding']}: {r['n']} ({r['examples']})")
    return int(any(r["kind"] == "error" for r in found))


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="kinmatch")
    sub = p.add_subparsers(dest="command", required=True)
    t = sub.add_parser("train")
    t.add_argument("data")
    t.add_argument("out")
    t.add_argument("--sample", type=int, default=30_000)
    t.add_argument("--trees", type=int, default=model.TREES)
    i = sub.add_parser("infer")
    i.add_argument("data")
    i.add_argument("model")
    i.add_argument("out")
    i.add_argument("--threshold", type=float)
    v = sub.add_parser("validate")
    v.add_argument("data")
    v.add_argument("matching")
    v.add_argument("candidate")
    v.add_argument("--check-ids", action="store_true")
    a = p.parse_args(args)
    spark = spark or SparkSession.builder.appName("kinmatch").getOrCreate()
    return {"train": train, "infer": infer, "validate": check}[a.command](spark, a)


if __name__ == "__main__":
    sys.exit(main())
