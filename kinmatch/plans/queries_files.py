"""Queries that write files and read them again: sources, results, checks, resumed runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as X
from ..sources import delimited, validate
from ..workspace import folder, written
from . import pipeline
from .registry import query
from .sql import over, q

PAIRS = "source1_entity_id, candidate_entity_id"


def _tsv(f, df: DataFrame, name: str) -> str:
    path = folder(f.spark, name)
    delimited.write_tsv(df, path)
    return path


def _raw(f, *src):
    return f.entities.where(F.col("src").isin(*src)).select(*S.SOURCE.names)


query("s01_tsv_scan_empty", q("select entity_id, business_name, business_address, coalesce(country, '') as country from w", "w as (select entity_id, business_name, trim(regexp_replace(business_address, '\\s+', ' ', 'g')) as business_address, country from ent where src = 0)"))(
    lambda f: delimited.read_tsv(f.spark, _tsv(f, _raw(f, 0).withColumn("business_address", F.trim(F.regexp_replace("business_address", "\\s+", " "))), "s01"), empty_as_null=False)
)
query("s03_tsv_scan_nulls", q("select entity_id, nullif(business_name, '') as business_name, country from ent where src = 0"))(
    lambda f: delimited.read_tsv(f.spark, _tsv(f, _raw(f, 0).withColumn("business_address", F.lit("x")), "s03")).select("entity_id", "business_name", "country")
)


@query("s05_read_all_sources", q("select entity_id, business_name, coalesce(country, '') as country from ent"))
def _all_sources(f):
    base = folder(f.spark, "s05")
    for k in range(3):
        delimited.write_tsv(_raw(f, k).withColumn("business_address", F.lit("x")), f"{base}/train_source{k + 1}.tsv")
    a, b, c = delimited.read_all_sources(f.spark, base, "train")
    return a.unionByName(b).unionByName(c).select("entity_id", "business_name", "country")


@query("s06_stage_sources", q("select entity_id, name_norm, address_norm, country_norm from nrm"))
def _stage(f):
    path = folder(f.spark, "s06")
    X.normalised(f.source(0, 1, 2)).write.parquet(path)
    return f.spark.read.parquet(path).select("entity_id", "name_norm", "address_norm", "country_norm")


query("s04_ground_truth_scan", q(f"select distinct {PAIRS} from truth"))(
    lambda f: pipeline.labeling.truth_pairs(
        delimited.read_tsv(f.spark, _tsv(f, f.truth.groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_set("candidate_entity_id")), ",").alias("matched_entity_ids")), "s04"), S.TRUTH)
    )
)
query("s11_id_set_scan", q("select entity_id as id from s1"))(lambda f: delimited.read_ids(f.spark, _tsv(f, f.s1.select("entity_id", F.lit("x").alias("y")), "s11")))
query("s12_target_ids", q("select entity_id as id from target"))(
    lambda f: delimited.read_ids(f.spark, _tsv(f, f.s2.select("entity_id", F.lit("x").alias("y")), "s12a")).union(delimited.read_ids(f.spark, _tsv(f, f.s3.select("entity_id", F.lit("x").alias("y")), "s12b"))).distinct()
)
_LISTS = "lists as (select entity_id as source1_entity_id, coalesce(string_agg(distinct candidate_entity_id, ',' order by candidate_entity_id), '') as candidate_entity_ids from s1 left join candidates on source1_entity_id = entity_id group by 1)"
_MATCHED = "matched as (select entity_id as source1_entity_id, coalesce(string_agg(candidate_entity_id, ',' order by candidate_entity_id) filter (score >= 0.5), '') as matched_entity_ids from s1 left join scored on source1_entity_id = entity_id group by 1)"
query("a08_sorted_id_lists", over("candidates", "select source1_entity_id, candidate_entity_ids from lists", _LISTS))(lambda f: delimited.id_lists(f.s1, f.candidates, "candidate_entity_ids"))


def _matches(f):
    return delimited.id_lists(f.s1, f.scored.where("score >= 0.5"), "matched_entity_ids")


query("k05_grouped_id_tsv", over("candidates", "select source1_entity_id, nullif(candidate_entity_ids, '') as candidate_entity_ids from lists", _LISTS))(
    lambda f: f.spark.read.csv(_tsv(f, delimited.id_lists(f.s1, f.candidates, "candidate_entity_ids"), "k05"), sep="\t", header=True)
)


@query("k06_source_order", over("scored", "select source1_entity_id, matched_entity_ids, doc_id as pos from matched join ent on entity_id = source1_entity_id", _MATCHED))
def _source_order(f):
    rows = _matches(f).join(f.s1.select(F.col("entity_id").alias("source1_entity_id"), F.col("doc_id").alias("pos")), "source1_entity_id")
    return rows.orderBy("pos")


query("k07_delimited_copy", q("select entity_id, country from ent where country is not null"))(lambda f: f.spark.read.csv(_tsv(f, f.entities.where("country is not null").select("entity_id", "country"), "k07"), sep="\t", header=True))
query("k08_score_dump", over("scored", f"select {PAIRS}, printf('%.8f', score) as confidence from scored"))(
    lambda f: f.spark.read.csv(_tsv(f, f.scored.select(*S.PAIR, F.format_string("%.8f", "score").alias("confidence")), "k08"), sep="\t", header=True)
)


@query("k01_stage_table", over("candidates", f"select {PAIRS} from candidates"))
def _stage_table(f):
    path = folder(f.spark, "k01")
    f.candidates.write.mode("overwrite").parquet(path)
    return f.spark.read.parquet(path)


@query("k03_insert_or_ignore", over("scored", f"select {PAIRS} from scored where score >= 0.4"))
def _insert(f):
    """A first insert, then one that overlaps it: pairs that are there stay as they are."""
    scored = f.scored
    path = folder(f.spark, "k03")
    scored.where("score >= 0.6").select(*S.PAIR).write.parquet(path)
    pipeline.insert_or_ignore(f.spark, path, scored.where("score >= 0.4").select(*S.PAIR))
    return f.spark.read.parquet(path)


query("k02_keyed_table", over("scored", f"select distinct {PAIRS} from scored where score >= 0.5"))(lambda f: (x := f.scored.where("score >= 0.5").select(*S.PAIR)).union(x).dropDuplicates(list(S.PAIR)))
query("s17_result_stats", over("scored", "select count(*) as rows, sum(n)::bigint as matches, count(*) filter (n = 0) as singletons, round(sum(n) / count(*), 6)::double as avg_matches, round(count(*) filter (n = 0) * 100.0 / count(*), 4)::double as singleton_pct from (select case when matched_entity_ids = '' then 0 else len(string_split(matched_entity_ids, ',')) end as n from matched)", _MATCHED))(
    lambda f: delimited.result_stats(_matches(f))
)
query("s14_output_row_count", over("scored", "select count(*) as n from matched", _MATCHED))(lambda f: f.spark.read.csv(_tsv(f, _matches(f), "s14"), sep="\t", header=True).agg(F.count(F.lit(1)).alias("n")))
query("s13_result_parser", over("scored", "select source1_entity_id as id, case when matched_entity_ids = '' then 0 else len(string_split(matched_entity_ids, ',')) end::bigint as n, false as malformed from matched", _MATCHED))(
    lambda f: validate.parsed(f.spark, _tsv(f, _matches(f), "s13")).where(F.col("id") != "source1_entity_id").select("id", F.size("ids").cast("long").alias("n"), "malformed")
)


# --- checks of results: faults are put into the lines of a result ---------------------------------

_BAD = "bad as (select entity_id, doc_id, case doc_id % 12 when 0 then entity_id || chr(9) || 'S2-1,S2-1' when 3 then entity_id || ' S2-4' when 6 then entity_id || chr(9) || 'S1-3' else entity_id || chr(9) || 'X-1,S3-2' end as line from s1 where doc_id % 30 <> 9)"


def _bad_lines(f):
    d = F.col("doc_id") % 12
    e = F.col("entity_id")
    line = F.when(d == 0, F.concat(e, F.lit("\tS2-1,S2-1"))).when(d == 3, F.concat(e, F.lit(" S2-4"))).when(d == 6, F.concat(e, F.lit("\tS1-3"))).otherwise(F.concat(e, F.lit("\tX-1,S3-2")))
    lines = f.s1.where("doc_id % 30 <> 9").select(line.alias("value"))
    again = f.s1.where("doc_id = 21").select(F.concat(e, F.lit("\tS3-2")).alias("value"))
    extra = f.spark.range(1).select(F.lit("S1-x\t").alias("value"))
    return validate.parsed_lines(lines.union(again).union(extra))


def _found(kind):
    return lambda f: validate.findings(_bad_lines(f), f.s1.select(F.col("entity_id").alias("id")), S.MATCHES, f.target.select(F.col("entity_id").alias("id"))).where(F.col("finding") == kind)


query("q05_malformed_rows", q("select 'malformed row' as finding, line as id from bad where doc_id % 12 = 3", _BAD))(_found("malformed row"))
query("q06_repeated_rows", q("select 'repeated row' as finding, entity_id as id from bad where doc_id = 21", _BAD))(_found("repeated row"))
query("q07_repeated_ids", q("select 'repeated id in a list' as finding, entity_id as id from bad where doc_id % 12 = 0", _BAD))(_found("repeated id in a list"))
query("q08_self_matches", q("select 'self match' as finding, entity_id as id from bad where doc_id % 12 = 6", _BAD))(_found("self match"))
query("q08_wrong_prefix", q("select 'wrong prefix' as finding, entity_id as id from bad where doc_id % 12 = 9", _BAD))(_found("wrong prefix"))
query("q09_unknown_ids", q("select distinct 'unknown id' as finding, entity_id as id from (select entity_id, unnest(string_split(split_part(line, chr(9), 2), ',')) as o from bad where doc_id % 12 <> 3) where o not in (select entity_id from target)", _BAD))(_found("unknown id"))
query("q10_missing_rows", q("select 'missing row' as finding, entity_id as id from s1 where entity_id not in (select entity_id from bad where doc_id % 12 <> 3)", _BAD))(_found("missing row"))
query("q10_extra_rows", q("select 'extra row' as finding, 'S1-x' as id", _BAD))(_found("extra row"))
query("q11_matches_outside_candidates", over("scored", "select 'match outside candidates' as finding, source1_entity_id as id from (select distinct source1_entity_id from scored where score >= 0.5 and score < 0.8)"))(
    lambda f: validate.outside_candidates(
        *[validate.parsed_lines(delimited.id_lists(f.s1, f.scored.where(w), "x").select(F.concat_ws("\t", "source1_entity_id", "x").alias("value"))) for w in ("score >= 0.5", "score >= 0.8")]
    )
)
query(
    "q12_bounded_examples",
    q(
        "select 'missing row' as finding, count(*) as n, array_to_string(list_sort(list(entity_id))[1:5], ',') as examples from (select distinct entity_id from s1 where entity_id not in (select entity_id from bad where doc_id % 12 <> 3)) having count(*) > 0",
        _BAD,
    ),
)(lambda f: validate.summary(_found("missing row")(f)))


def _text(f, name: str, header: str, lines: DataFrame) -> str:
    """A small file of lines under a header, in one part so that the header is first."""
    path = folder(f.spark, name)
    whole = f.spark.createDataFrame([(0, header)], "k int, value string").union(lines.select(F.lit(1), "*"))
    whole.coalesce(1).sortWithinPartitions("k").select("value").write.text(path)
    return path


_Q03 = """
select 'malformed row' as finding, line as id from bad where doc_id % 12 = 3
union all select 'repeated row', entity_id from bad where doc_id = 21
union all select 'repeated id in a list', entity_id from bad where doc_id % 12 = 0
union all select 'self match', entity_id from bad where doc_id % 12 = 6
union all select 'wrong prefix', entity_id from bad where doc_id % 12 = 9
union all select distinct 'unknown id', entity_id from (select entity_id, unnest(string_split(split_part(line, chr(9), 2), ',')) as o from bad where doc_id % 12 <> 3) where o not in (select entity_id from target)
union all select 'missing row', entity_id from s1 where entity_id not in (select entity_id from bad where doc_id % 12 <> 3)
union all select 'extra row', 'S1-x'
union all select 'comma-separated header', 'candidate_entity_ids'
union all select 'match outside candidates', entity_id from bad where doc_id % 12 in (6, 9)
"""


@query("q03_validate_outputs", q(_Q03, _BAD))
def _validate(f):
    """A result file with faults of each kind, and a candidate file with a wrong header."""
    lines = _bad_lines(f).select("value")
    matching = _text(f, "q03m", "\t".join(S.MATCHES), lines)
    candidate = _text(f, "q03c", ",".join(S.CANDIDATES), f.s1.select(F.concat("entity_id", F.lit("\tS2-1"))))
    known = f.target.select(F.col("entity_id").alias("id"))
    errors, warnings = validate.validate(f.spark, matching, candidate, f.s1.select(F.col("entity_id").alias("id")), known)
    return errors.union(warnings)


_HEADERS = {"empty": "", "comma": ",".join(S.MATCHES), "other": "a\tb", "good": "Source1_Entity_ID\tMATCHED_ENTITY_IDS"}


@query("q04_header_checks", "select * from (values ('empty', 'empty file'), ('comma', 'comma-separated header'), ('other', 'unexpected header'), ('good', null)) v(file, fault)")
def _headers(f):
    first = {name: validate.first_line(f.spark, _text(f, f"q04-{name}", header, f.s1.select("entity_id"))) for name, header in _HEADERS.items()}
    return f.spark.createDataFrame([(name, validate.header_fault(line, S.MATCHES)) for name, line in first.items()], "file string, fault string")


@query(
    "q01_inspect_files",
    q(
        "select 'source' || (src + 1) as file, c as column, count(*) as rows, count(*) filter (coalesce(case c when 'entity_id' then entity_id when 'business_name' then business_name when 'business_address' then 'x' else country end, '') = '') as missing "
        "from ent, (values ('entity_id'), ('business_name'), ('business_address'), ('country')) v(c) group by src, c"
    ),
)
def _inspect(f):
    return delimited.inspect_files(f.spark, {f"source{k + 1}": _tsv(f, _raw(f, k).withColumn("business_address", F.lit("x")), f"q01-{k}") for k in range(3)})


query("q02_source_faults", q("select 'repeated ids' as fault, count(*) as n from s1 where doc_id % 5 = 1 union all select 'wrong prefix', count(*) from ent where src = 1 and doc_id % 7 = 0"))(
    lambda f: delimited.source_faults(_raw(f, 0).union(f.entities.where("src = 0 and doc_id % 5 = 1").select(*S.SOURCE.names)).union(f.entities.where("src = 1 and doc_id % 7 = 0").select(*S.SOURCE.names)), "S1-")
)


@query("k11_package", over("scored", "select 'good' as result, null as fault union all select 'faulty', 'missing row'"))
def _package(f):
    """Two results, one of which lacks rows: the packager's validator lets the other pass."""
    scored = written(f.scored, "scored")
    required, rows = f.s1.select(F.col("entity_id").alias("id")), []
    candidate = _tsv(f, delimited.id_lists(f.s1, scored.select(*S.PAIR), "candidate_entity_ids"), "k11c")
    lists = delimited.id_lists(f.s1, scored.where("score >= 0.5"), "matched_entity_ids")
    for name, result in (("good", lists), ("faulty", lists.where("source1_entity_id < 'S1-5'"))):
        try:
            pipeline.export_package(f.spark, folder(f.spark, f"k11-{name}") + ".zip", _tsv(f, result, "k11m"), candidate, required)
            rows.append((name, None))
        except pipeline.Refused as e:
            rows.append((name, str(e).split(": ")[1]))
    return f.spark.createDataFrame(rows, "result string, fault string")


@query("k04_dropped_tables", "select * from (values ('kept', true), ('dropped', false)) v(name, there)")
def _dropped(f):
    paths = {name: folder(f.spark, name) for name in ("kept", "dropped")}
    for path in paths.values():
        f.s1.select("entity_id").write.parquet(path)
    pipeline.drop(f.spark, paths["dropped"], folder(f.spark, "never"))
    return f.spark.createDataFrame([(name, pipeline.finished(f.spark, path)) for name, path in paths.items()], "name string, there boolean")


@query("r03_resume_states", "select * from (values (0, 'new', 'candidates'), (1, 'resumable', 'scored'), (2, 'finished', null)) v(stages, state, ahead)")
def _states(f):
    out, rows = folder(f.spark, "r03"), []
    for k in range(3):
        rows.append((k, *pipeline.resume_state(f.spark, out, pipeline.LINK_STAGES)))
        if k < 2:
            pipeline.stage(f.spark, f"{out}/{pipeline.LINK_STAGES[k]}", lambda: f.s1.select("entity_id"))
    return f.spark.createDataFrame(rows, "stages int, state string, ahead string")


@query("r07_preflight", "select * from (values ('all there', true), ('an input is missing', false), ('a table is not finished', false)) v(name, passed)")
def _preflight(f):
    whole, absent = folder(f.spark, "whole"), folder(f.spark, "absent")
    f.s1.select("entity_id").write.parquet(whole)
    rows = []
    for name, inputs, tables in (("all there", [whole], [whole]), ("an input is missing", [absent], []), ("a table is not finished", [], [absent])):
        try:
            pipeline.preflight(f.spark, inputs, tables)
            rows.append((name, True))
        except FileNotFoundError:
            rows.append((name, False))
    return f.spark.createDataFrame(rows, "name string, passed boolean")


@query("r08_manifest", "select * from (values ('new run', true), ('resumed', true), ('other settings', false)) v(name, passed)")
def _manifest(f):
    out, rows = folder(f.spark, "r08"), []
    for name, facts in (("new run", {"top": 40}), ("resumed", {"top": 40}), ("other settings", {"top": 41})):
        try:
            pipeline.manifest(f.spark, out, facts)
            rows.append((name, True))
        except ValueError:
            rows.append((name, False))
    return f.spark.createDataFrame(rows, "name string, passed boolean")


@query("r02_resumed_run", over("scored", "select source1_entity_id, candidate_entity_id, score from scored where score >= 0.5"))
def _resumed(f):
    """Half of the buckets, a stop, and a second run that does the rest."""
    out = folder(f.spark, "r02")
    run = pipeline.BucketedRun(f.spark, out, 4)
    scored = f.scored
    run.go(scored, 0.5, stop_after=2)
    run.go(scored, 0.5)
    return run.result().select(*S.PAIR, "score")
