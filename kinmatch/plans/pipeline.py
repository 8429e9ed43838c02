"""Staged runs: each stage is a table that a later run finds finished, and skips.

The whole linkage is one lazy plan cut at stage edges. Selected pairs are written by buckets of
source entities, all open buckets in one job, so the scores are computed once; a bucket gets its
mark after the job, and a run that stopped goes on with the buckets that lack one.
"""

from __future__ import annotations

import io
import json
import os
import zipfile
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import blocking, evaluate, features, labeling, model
from ..sources import delimited, validate


#: Stages of a run, in order, as the tables that they leave.
TRAIN_STAGES = ("sample", "labelled", "features", "matcher/settings")
LINK_STAGES = ("candidates", "scored")


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    files, p = _file(spark, path)
    return bool(files.exists(p))


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end, on any file system that Spark reads."""
    return exists(spark, f"{path}/_SUCCESS")


def drop(spark: SparkSession, *paths: str) -> None:
    """Removes tables that are there, so that a later run makes them again."""
    for path in paths:
        files, p = _file(spark, path)
        files.delete(p, True)


def stage(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at `path`, made unless it is finished."""
    if not finished(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def resume_state(spark: SparkSession, out: str, stages: tuple[str, ...] = TRAIN_STAGES) -> tuple[str, str | None]:
    """Where a run stands: `new`, `resumable` or `finished`, and the stage that comes next."""
    done = [finished(spark, f"{out}/{s}") for s in stages]
    ahead = next((s for s, d in zip(stages, done) if not d), None)
    return ("finished" if ahead is None else "resumable" if done[0] else "new"), ahead


def preflight(spark: SparkSession, inputs: list[str], tables: list[str] = ()) -> None:
    """Before a run that may take hours: all inputs are there, and all tables finished."""
    missing = [p for p in inputs if not exists(spark, p)] + [p for p in tables if not finished(spark, p)]
    if missing:
        raise FileNotFoundError("not there, or not finished: " + ", ".join(missing))


def manifest(spark: SparkSession, out: str, facts: dict) -> dict:
    """Notes the settings of a run in its folder. A run that is resumed must have the same ones:
    its finished stages were made with them."""
    files, p = _file(spark, f"{out}/manifest.json")
    text = json.dumps(facts, sort_keys=True)
    if files.exists(p):
        known = json.loads(spark.read.text(str(p)).first()[0])
        if known != json.loads(text):
            changed = sorted(k for k in {*known, *facts} if known.get(k) != json.loads(text).get(k))
            raise ValueError(f"{out} was begun with other settings: {', '.join(changed)}")
        return known
    _, part = _file(spark, f"{out}/manifest.json.tmp")
    stream = files.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    files.rename(part, p)
    return facts


def insert_or_ignore(spark: SparkSession, path: str, new: DataFrame, ids: tuple[str, ...] = S.PAIR) -> None:
    """Appends the rows whose ids aren't in the table yet, each once."""
    old = spark.read.parquet(path).select(*ids)
    new.dropDuplicates(list(ids)).join(old, list(ids), "left_anti").write.mode("append").parquet(path)


class BucketedRun:
    """Selected pairs by bucket of the source entity."""

    def __init__(self, spark: SparkSession, out: str, buckets: int = 16):
        self.spark, self.out, self.buckets = spark, out, buckets

    def _mark(self, k: int) -> str:
        return f"{self.out}/_finished-{k}"

    def open_buckets(self) -> list[int]:
        return [k for k in range(self.buckets) if not exists(self.spark, self._mark(k))]

    def go(self, scored: DataFrame, threshold: float, stop_after: int | None = None) -> list[int]:
        """Does the open buckets and returns them; `stop_after` ends the run early. Buckets that
        an earlier job left unmarked are replaced, marked ones stay."""
        todo = self.open_buckets()[:stop_after]
        if not todo:
            return []
        own = scored.withColumn("bucket", labeling.bucket("source1_entity_id", self.buckets).cast("int")).where(F.col("bucket").isin(todo) & (F.col("score") >= threshold))
        drop(self.spark, *[f"{self.out}/bucket={k}" for k in todo])
        own.write.mode("append").partitionBy("bucket").parquet(self.out)
        for k in todo:
            files, p = _file(self.spark, self._mark(k))
            files.create(p, True).close()
        self.schema = scored.schema
        return todo

    def result(self, schema=None) -> DataFrame:
        left = self.open_buckets()
        if left:
            raise RuntimeError(f"buckets not finished: {left}")
        schema = schema or getattr(self, "schema", None)
        return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(self.out).drop("bucket")


def link(spark: SparkSession, s1: DataFrame, target: DataFrame, scorer: Callable[[DataFrame], DataFrame], out: str, settings: S.Settings = S.DEFAULT) -> DataFrame:
    """Normalised sources to selected pairs, with both result files under `out`."""
    manifest(spark, out, {"job": "link", **asdict(settings)})
    candidates = stage(spark, f"{out}/candidates", lambda: blocking.candidates(s1, target, settings))
    scored = stage(spark, f"{out}/scored", lambda: scorer(features.make_features(candidates, s1, target)))
    run = BucketedRun(spark, f"{out}/selected")
    run.go(scored, settings.threshold)
    selected = run.result(scored.schema)
    evaluate.guard(selected, scored, settings.threshold)
    delimited.write_tsv(delimited.id_lists(s1, candidates, S.CANDIDATES[1]), f"{out}/candidate_pairs", "source1_entity_id")
    delimited.write_tsv(delimited.id_lists(s1, selected, S.MATCHES[1]), f"{out}/matching_results", "source1_entity_id")
    return selected


def train(spark: SparkSession, s1: DataFrame, target: DataFrame, truth: DataFrame, out: str, settings: S.Settings = S.DEFAULT, sample: int = 30_000, trees: int = model.TREES) -> float:
    """Fits the matcher on a sample of source entities and saves it with its threshold. A run that
    stopped goes on from the tables that it left, a finished one returns its threshold."""
    manifest(spark, out, {"job": "train", "sample": sample, "trees": trees, **asdict(settings)})
    if resume_state(spark, out)[0] == "finished":
        return model.load(spark, f"{out}/matcher")[1]["threshold"]
    some = stage(spark, f"{out}/sample", lambda: labeling.sample(s1, sample))
    pairs = stage(spark, f"{out}/labelled", lambda: labeling.labelled(blocking.candidates(some, target, settings), truth))
    rows = stage(spark, f"{out}/features", lambda: features.make_features(pairs, some, target).withColumn("label", F.col("label").cast("double")))
    fitted, threshold, _ = model.train_validate(rows, settings.thresholds, trees)
    model.save(fitted, f"{out}/matcher", threshold)
    return threshold


def write_atomically(path: str, text: str) -> None:
    """A small local file, whole or not at all."""
    temporary = f"{path}.tmp"
    with open(temporary, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(temporary, path)


class Refused(ValueError):
    """The validator found errors, so that nothing was packaged."""


def package(path: str, files: dict[str, str], errors: int) -> None:
    """A ZIP of small files by name; refused while the validator has errors."""
    if errors:
        raise Refused(f"{errors} errors: not packaged")
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in sorted(files.items()):
            z.writestr(name, text)
        z.writestr("manifest.json", json.dumps(sorted(files)))
    with open(f"{path}.tmp", "wb") as f:
        f.write(held.getvalue())
    os.replace(f"{path}.tmp", path)


def export_package(spark: SparkSession, path: str, matching: str, candidate: str, required: DataFrame, known: DataFrame | None = None) -> list[str]:
    """Validates both result files and, if they have no errors, packs them into a ZIP, by streams
    of the file system, so that files of any size pass through. Returns the entries' names."""
    errors, _ = validate.validate(spark, matching, candidate, required, known)
    found = validate.summary(errors).collect()
    if found:
        raise Refused("not packaged: " + "; ".join(f"{r['finding']}: {r['n']} ({r['examples']})" for r in found))
    jvm = spark._jvm
    files, part = _file(spark, f"{path}.tmp")
    names = []
    z = jvm.java.util.zip.ZipOutputStream(files.create(part, True))
    for source in (matching, candidate):
        own, folder_ = _file(spark, source)
        parts = sorted((x.getPath() for x in own.listStatus(folder_) if x.getPath().getName().startswith("part-")), key=lambda p: p.getName())
        for k, p in enumerate(parts):
            names.append(f"{folder_.getName()}-{k:05d}.tsv")
            z.putNextEntry(jvm.java.util.zip.ZipEntry(names[-1]))
            stream = own.open(p)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, z, 1 << 16, False)
            stream.close()
            z.closeEntry()
    z.close()
    _, whole = _file(spark, path)
    files.delete(whole, False)
    files.rename(part, whole)
    return names
