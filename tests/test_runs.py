"""Labels, thresholds, files, checks and resumed runs."""

import zipfile

import pytest
from pyspark.sql import functions as F

from kinmatch import schema as S
from kinmatch import workspace
from kinmatch.operators import evaluate, features, labeling, model
from kinmatch.plans import pipeline
from kinmatch.plans.fixtures import Frames
from kinmatch.sources import delimited, validate

SF = "/root/testdata/sf0.001"


def test_truth_of_singletons(spark):
    wide = spark.createDataFrame([("S1-1", "S2-1,S3-1,S2-1"), ("S1-2", ""), ("S1-3", None)], S.TRUTH)
    assert sorted(map(tuple, labeling.truth_pairs(wide).collect())) == [("S1-1", "S2-1"), ("S1-1", "S3-1")]


def test_split_keeps_entities_whole(spark):
    rows = Frames(spark, SF).candidates.withColumn("part", labeling.bucket("source1_entity_id", 5))
    assert rows.groupBy("source1_entity_id").agg(F.countDistinct("part").alias("n")).where("n > 1").count() == 0


def test_thresholds(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.2, 1)], "score double, label int")
    got = {r.threshold: (r.tp, r.fp, r.fn) for r in evaluate.confusion(df, (0.5, 0.85, 0.95)).collect()}
    assert got == {0.5: (1, 1, 1), 0.85: (1, 0, 1), 0.95: (0, 0, 2)}
    assert evaluate.tuned(evaluate.measures(evaluate.confusion(df, (0.5, 0.85, 0.95)))).first().threshold == 0.85


def test_guard(spark):
    scored = spark.createDataFrame([("a", 0.9)], "id string, score double")
    evaluate.guard(scored, scored, 0.5)
    with pytest.raises(evaluate.EmptySelection):
        evaluate.guard(scored.limit(0), scored, 0.5)
    evaluate.guard(scored.limit(0), scored, 0.95)


def test_aligned(spark):
    df = spark.createDataFrame([(float("nan"), float("inf"), None)], "name_edit double, name_exact double, address_edit double")
    assert features.aligned(df, ["name_edit", "name_exact", "address_edit", "country_exact"]).first() == (0.0, 0.0, 0.0, 0.0)


def test_tsv_round_trip(spark, tmp_path):
    rows = [("S1-2", 'a "q" ', "", None), ("S1-1", " x", "NA", "us")]
    delimited.write_tsv(spark.createDataFrame(rows, S.SOURCE), str(tmp_path / "t"), "entity_id")
    assert sorted(map(tuple, delimited.read_tsv(spark, str(tmp_path / "t"), empty_as_null=False).collect())) == [("S1-1", " x", "NA", "us"), ("S1-2", 'a "q" ', "", "")]


def test_source_faults(spark):
    df = spark.createDataFrame([("S1-1",), ("S1-1",), ("S2-1",)], "entity_id string")
    assert delimited.source_faults(df, "S1-").first().fault.startswith("missing columns")
    full = df.select("entity_id", *[F.lit("").alias(c) for c in S.SOURCE.names[1:]])
    assert {(r.fault, r.n) for r in delimited.source_faults(full, "S1-").collect()} == {("repeated ids", 1), ("wrong prefix", 1)}


def test_headers():
    assert validate.header_fault("", S.MATCHES) == "empty file"
    assert validate.header_fault("source1_entity_id,matched_entity_ids", S.MATCHES) == "comma-separated header"
    assert validate.header_fault("a\tb", S.MATCHES) == "unexpected header"
    assert validate.header_fault("Source1_Entity_ID\tmatched_entity_ids", S.MATCHES) is None


def test_findings(spark):
    lines = ["source1_entity_id\tmatched_entity_ids", "S1-1\tS2-1,S2-1", "S1-1\t", "S1-2\tS1-1", "S1-3\tX-1", "S1-9\t", "oops"]
    rows = validate.parsed_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    required = spark.createDataFrame([(f"S1-{k}",) for k in (1, 2, 3, 4)], "id string")
    got = {(r.finding, r.id) for r in validate.findings(rows, required, S.MATCHES).collect()}
    assert got == {
        ("repeated id in a list", "S1-1"), ("repeated row", "S1-1"), ("self match", "S1-2"), ("wrong prefix", "S1-3"),
        ("extra row", "S1-9"), ("malformed row", "oops"), ("missing row", "S1-4"),
    }


def test_link_and_resume(spark, tmp_path):
    f = Frames(spark, SF)
    calls = []

    def scorer(df):
        calls.append(1)
        return df.withColumn("score", F.col("name_char_jaccard"))

    settings = S.Settings(threshold=0.5)
    out = str(tmp_path / "run")
    first = pipeline.link(spark, f.s1, f.target, scorer, out, settings).count()
    again = pipeline.link(spark, f.s1, f.target, scorer, out, settings)
    assert again.count() == first > 0 and len(calls) == 1
    assert again.select(*S.PAIR).join(f.candidates, list(S.PAIR), "left_anti").count() == 0
    ids = f.s1.select(F.col("entity_id").alias("id"))
    errors, warnings = validate.validate(spark, f"{out}/matching_results", f"{out}/candidate_pairs", ids, f.target.select(F.col("entity_id").alias("id")))
    assert errors.count() == warnings.count() == 0


def test_buckets_resume(spark, tmp_path):
    scored = spark.createDataFrame([(f"S1-{k}", "S2-1", 0.9) for k in range(40)], "source1_entity_id string, candidate_entity_id string, score double")
    run = pipeline.BucketedRun(spark, str(tmp_path / "b"), 4)
    assert len(run.go(scored, 0.5, stop_after=1)) == 1
    with pytest.raises(RuntimeError):
        run.result()
    assert len(run.go(scored, 0.5)) == 3 and run.go(scored, 0.5) == []
    assert run.result().count() == 40


def test_model_round_trip(spark, tmp_path):
    f = Frames(spark, SF)
    rows = f.features.withColumn("label", F.col("label").cast("double"))
    fitted = model.fit(rows, trees=2, depth=2)
    model.save(fitted, str(tmp_path / "m"), 0.9)
    loaded, note = model.load(spark, str(tmp_path / "m"))
    assert note["threshold"] == 0.9
    a = model.predict(rows, fitted).select("score").collect()
    assert sorted(a) == sorted(model.predict(rows, loaded).select("score").collect())


def test_package(spark, tmp_path):
    with pytest.raises(ValueError):
        pipeline.package(str(tmp_path / "x.zip"), {"a": "1"}, 2)
    pipeline.package(str(tmp_path / "x.zip"), {"a": "1"}, 0)
    pipeline.write_atomically(str(tmp_path / "t"), "hello")
    assert (tmp_path / "x.zip").exists() and (tmp_path / "t").read_text() == "hello"


def test_export_package(spark, tmp_path):
    ids = [f"S1-{k}" for k in range(4)]
    required = spark.createDataFrame([(x,) for x in ids], "id string")

    def file(name, column, lists):
        path = str(tmp_path / name)
        delimited.write_tsv(spark.createDataFrame(lists, f"source1_entity_id string, {column} string"), path)
        return path

    candidate = file("candidate_pairs", "candidate_entity_ids", [(x, "S2-1,S3-2") for x in ids])
    good = file("matching_results", "matched_entity_ids", [(x, "S2-1") for x in ids])
    names = pipeline.export_package(spark, str(tmp_path / "out.zip"), good, candidate, required)
    with zipfile.ZipFile(tmp_path / "out.zip") as z:
        assert z.namelist() == names and z.testzip() is None
        lines = [x for n in names if n.startswith("matching") for x in z.read(n).decode().splitlines()]
    assert {x for x in lines if x.startswith("S1-")} == {f"{x}\tS2-1" for x in ids}
    bad = file("bad", "matched_entity_ids", [(x, "S1-1") for x in ids[:3]])
    with pytest.raises(pipeline.Refused, match="self match"):
        pipeline.export_package(spark, str(tmp_path / "bad.zip"), bad, candidate, required)
    assert not (tmp_path / "bad.zip").exists()


def test_train_resumes_from_its_tables(spark, tmp_path, monkeypatch):
    f, out, made = Frames(spark, SF), str(tmp_path / "t"), []
    real = pipeline.stage

    def stage(spark_, path, make):
        made.extend([path.rsplit("/", 1)[1]] * (not pipeline.finished(spark_, path)))
        return real(spark_, path, make)

    monkeypatch.setattr(pipeline, "stage", stage)
    assert pipeline.resume_state(spark, out) == ("new", "sample")
    monkeypatch.setattr(model, "train_validate", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        pipeline.train(spark, f.s1, f.target, f.truth, out, trees=2)
    assert made == ["sample", "labelled", "features"] and pipeline.resume_state(spark, out) == ("resumable", "matcher/settings")
    monkeypatch.undo()
    monkeypatch.setattr(pipeline, "stage", stage)
    threshold = pipeline.train(spark, f.s1, f.target, f.truth, out, trees=2)
    assert made == ["sample", "labelled", "features"] and pipeline.resume_state(spark, out) == ("finished", None)
    assert pipeline.train(spark, f.s1, f.target, f.truth, out, trees=2) == threshold
    with pytest.raises(ValueError, match="trees"):
        pipeline.train(spark, f.s1, f.target, f.truth, out, trees=3)


def test_preflight(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "whole"))
    (tmp_path / "part").mkdir()
    pipeline.preflight(spark, [str(tmp_path / "part")], [str(tmp_path / "whole")])
    with pytest.raises(FileNotFoundError, match="part"):
        pipeline.preflight(spark, [], [str(tmp_path / "part")])
    pipeline.drop(spark, str(tmp_path / "whole"), str(tmp_path / "absent"))
    assert not pipeline.exists(spark, str(tmp_path / "whole"))


def test_selection_guard_of_a_run(spark, tmp_path, monkeypatch):
    """A run whose selection is lost, though scores qualify, exports nothing."""
    f = Frames(spark, SF)
    monkeypatch.setattr(pipeline.BucketedRun, "go", lambda self, scored, threshold, stop_after=None: [])
    monkeypatch.setattr(pipeline.BucketedRun, "result", lambda self, schema=None: f.scored.limit(0))
    with pytest.raises(evaluate.EmptySelection):
        pipeline.link(spark, f.s1, f.target, lambda df: df.withColumn("score", F.lit(1.0)), str(tmp_path / "run"), S.Settings(threshold=0.5))
    assert not pipeline.exists(spark, str(tmp_path / "run/matching_results"))


def test_scores_by_entities(spark):
    f = Frames(spark, SF)
    fitted = model.fit(f.features.withColumn("label", F.col("label").cast("double")), trees=2, depth=2)
    ids = f.s1.orderBy("entity_id").limit(20).select("entity_id")
    some = model.score_entities(f.candidates, ids, f.s1, f.target, model.scorer(fitted), 0.0)
    whole = model.score_candidates(f.candidates, f.s1, f.target, model.scorer(fitted))
    own = whole.join(ids.withColumnRenamed("entity_id", "source1_entity_id"), "source1_entity_id", "left_semi")
    assert sorted(tuple(r) for r in some.select(*S.PAIR, "score").collect()) == sorted(tuple(r) for r in own.select(*S.PAIR, "score").collect()) != []


def test_folder_needs_a_shared_one_on_a_cluster(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://head:7077", "app-1"

    class Session:
        sparkContext, conf = Context, type("C", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.root(Session)
    table = workspace.written(spark.range(3), "t")
    assert table.count() == 3 and table._written_at.startswith(workspace.root(spark))
    workspace.discard(table)
    assert not pipeline.exists(spark, table._written_at)
