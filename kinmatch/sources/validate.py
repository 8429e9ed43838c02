"""Checks of result files, as findings: one row per offence, found by set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXAMPLES = 5


def parsed(spark: SparkSession, path: str) -> DataFrame:
    """(value, id, ids, malformed) of each line; a line without a tab is malformed."""
    return parsed_lines(spark.read.text(path))


def parsed_lines(lines: DataFrame) -> DataFrame:
    parts = F.split("value", "\t", 2)
    ids = F.filter(F.transform(F.split(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return lines.where(F.trim("value") != "").select("value", F.trim(F.get(parts, F.lit(0))).alias("id"), ids.alias("ids"), (F.instr("value", "\t") == 0).alias("malformed"))


def header_fault(first: str | None, columns: tuple[str, str]) -> str | None:
    if not (first or "").strip():
        return "empty file"
    if "\t" not in first and "," in first:
        return "comma-separated header"
    if [x.strip().lower() for x in first.split("\t")] != list(columns):
        return "unexpected header"
    return None


def first_line(spark: SparkSession, path: str) -> str | None:
    lines = spark.read.text(path).limit(1).collect()
    return lines[0][0] if lines else None


def _is_header(columns: tuple[str, str]):
    return F.lower(F.col("value")).isin("\t".join(columns), ",".join(columns))


def findings(rows: DataFrame, required: DataFrame, columns: tuple[str, str], known: DataFrame | None = None) -> DataFrame:
    """(finding, id) of parsed rows. `required` and `known` have one column id.

    Rows are read once for all findings but the unknown ids: flags are added up for each id, and
    one outer join with the required ids tells the missing and the extra ones."""
    rows = rows.where(~_is_header(columns))
    prefixed = lambda x, *ps: reduce(lambda a, b: a | b, [x.startswith(p) for p in ps])
    flags = {
        "malformed row": F.bool_or("malformed"),
        "repeated row": F.count(F.lit(1)) > 1,
        "repeated id in a list": F.bool_or(F.size("ids") != F.size(F.array_distinct("ids"))),
        "self match": F.bool_or(F.exists("ids", lambda x: prefixed(x, "S1-"))),
        "wrong prefix": F.bool_or(F.exists("ids", lambda x: ~prefixed(x, "S1-", "S2-", "S3-"))),
    }
    bad = F.col("malformed")
    per_id = rows.groupBy(bad.alias("bad"), F.when(bad, F.col("value")).otherwise(F.col("id")).alias("id")).agg(*[f.alias(f"f{k}") for k, f in enumerate(flags.values())])
    needed = required.select(F.col("id").alias("needed")).distinct()
    both = per_id.join(needed, F.when(~F.col("bad"), F.col("id")) == F.col("needed"), "full_outer")
    good = ~F.coalesce("bad", F.lit(False))
    said = [F.when(F.col("f0"), F.lit("malformed row"))]
    said += [F.when(good & F.col(f"f{k}"), F.lit(name)) for k, name in enumerate(flags) if k]
    said += [F.when(F.col("id").isNull(), F.lit("missing row")), F.when(good & F.col("needed").isNull(), F.lit("extra row"))]
    out = both.select(F.explode(F.array_compact(F.array(*said))).alias("finding"), F.coalesce("id", "needed").alias("id"))
    if known is not None:
        each = rows.where(~bad).select("id", F.explode("ids").alias("other"))
        unknown = each.join(known.select(F.col("id").alias("other")), "other", "left_anti")
        out = out.union(unknown.select(F.lit("unknown id"), "id").distinct())
    return out


def outside_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Ids of rows whose matches aren't all among their candidates: a warning."""
    m = matches.where("not malformed").select("id", F.explode("ids").alias("other"))
    c = candidates.where("not malformed").select("id", F.explode("ids").alias("other"))
    return m.join(c, ["id", "other"], "left_anti").select(F.lit("match outside candidates").alias("finding"), "id").distinct()


def summary(found: DataFrame) -> DataFrame:
    """Counts of each finding and its first EXAMPLES ids."""
    firsts = F.slice(F.array_sort(F.collect_set("id")), 1, EXAMPLES)
    return found.groupBy("finding").agg(F.count(F.lit(1)).alias("n"), F.array_join(firsts, ",").alias("examples"))


def validate(spark: SparkSession, matching: str, candidate: str, required: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(errors, warnings) of the two result files. A fault of a header is named by the column
    that the file should have."""
    from ..schema import CANDIDATES, MATCHES

    m, c = parsed(spark, matching), parsed(spark, candidate)
    errors = findings(m, required, MATCHES, known).union(findings(c, required, CANDIDATES, known))
    for path, columns in ((matching, MATCHES), (candidate, CANDIDATES)):
        fault = header_fault(first_line(spark, path), columns)
        if fault:
            errors = errors.union(spark.createDataFrame([(fault, columns[1])], "finding string, id string"))
    return errors, outside_candidates(m.where(~_is_header(MATCHES)), c.where(~_is_header(CANDIDATES)))
