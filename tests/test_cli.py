"""The command line from sources to checked results, and the streaming extension."""

from pyspark.sql import functions as F

from kinmatch import cli
from kinmatch import schema as S
from kinmatch.operators import blocking
from kinmatch.plans.fixtures import Frames
from kinmatch.sources import delimited
from kinmatch.streaming import incremental

SF = "/root/testdata/sf0.001"


def test_train_infer_validate(spark, tmp_path):
    f = Frames(spark, SF)
    data, flat = str(tmp_path / "data"), F.regexp_replace("business_address", "\\s+", " ")
    for stem in ("train", "test"):
        for k in range(3):
            rows = f.entities.where(F.col("src") == k).withColumn("business_address", flat).select(*S.SOURCE.names)
            delimited.write_tsv(rows, f"{data}/{stem}_source{k + 1}.tsv", one_file=True)
    wide = delimited.id_lists(f.s1, f.truth, "matched_entity_ids")
    delimited.write_tsv(wide, f"{data}/train_ground_truth.tsv")
    out = str(tmp_path / "out")
    assert cli.main(["infer", data, out, out], spark) == 1
    assert cli.main(["train", data, out, "--trees", "3"], spark) == 0
    assert cli.main(["infer", data, out, f"{out}/run", "--threshold", "0.5"], spark) == 0
    assert cli.main(["validate", data, f"{out}/run/matching_results", f"{out}/run/candidate_pairs", "--check-ids"], spark) == 0
    assert cli.main(["validate", data, f"{data}/test_source1.tsv", f"{out}/run/candidate_pairs"], spark) == 1
    assert cli.main(["validate", data, str(tmp_path / "absent"), f"{out}/run/candidate_pairs"], spark) == 1


def test_incremental(spark, tmp_path):
    f = Frames(spark, SF)
    new = f.source(2).select(*S.SOURCE.names)
    new.write.parquet(str(tmp_path / "in"))
    left = blocking.keyed(f.s1)
    counts = blocking.frequencies(blocking.keyed(f.s2))
    stream = spark.readStream.schema(new.schema).parquet(str(tmp_path / "in"))
    incremental.start(stream, left, counts, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = {(r[0], r[1]) for r in spark.read.parquet(str(tmp_path / "out")).select(*S.PAIR).collect()}
    batch = {tuple(r) for r in f.candidates.where("candidate_entity_id like 'S3-%'").collect()}
    assert got and batch <= got
