"""Delimited sources and sinks, their statistics and checks of sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S


def read_tsv(spark: SparkSession, path: str, schema=S.SOURCE, empty_as_null: bool = True) -> DataFrame:
    """All columns are strings. Empty fields are null, or '' with empty_as_null=False."""
    df = spark.read.schema(schema).csv(path, sep="\t", header=True, escape='"')
    return df if empty_as_null else df.fillna("")


def read_all_sources(spark: SparkSession, folder: str, stem: str) -> list[DataFrame]:
    found = []
    for k in (1, 2, 3):
        df = read_tsv(spark, f"{folder}/{stem}_source{k}.tsv", empty_as_null=False)
        faults = [r["fault"] for r in source_faults(df, f"S{k}-").collect()]  # three kinds at most
        if faults:
            raise ValueError(f"{stem}_source{k}: {', '.join(faults)}")
        found.append(df)
    return found


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of the first column, without the header and blank lines."""
    first = F.trim(F.split_part(F.col("value"), F.lit("\t"), F.lit(1)))
    return spark.read.text(path).select(first.alias("id")).where("id <> '' and id <> 'entity_id'").distinct()


def source_faults(df: DataFrame, prefix: str) -> DataFrame:
    """(fault, n) rows: missing columns, repeated ids, ids of another prefix."""
    spark = df.sparkSession
    absent = [c for c in S.SOURCE.names if c not in df.columns]
    if absent:
        return spark.createDataFrame([("missing columns: " + ",".join(absent), len(absent))], "fault string, n long")
    repeated = df.groupBy("entity_id").count().where("count > 1").agg(F.lit("repeated ids").alias("fault"), F.count(F.lit(1)).alias("n"))
    odd = df.where(~F.coalesce(F.col("entity_id").startswith(prefix), F.lit(False))).agg(F.lit("wrong prefix").alias("fault"), F.count(F.lit(1)).alias("n"))
    return repeated.union(odd).where("n > 0")


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, rows, missing) for each column: one aggregate, then one row per column."""
    gap = lambda c: F.count_if(F.col(c).isNull() | (F.col(c) == ""))
    sums = df.agg(F.count(F.lit(1)).alias("rows"), *[gap(c).alias(f"m{k}") for k, c in enumerate(df.columns)])
    parts = [F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"m{k}").alias("missing")) for k, c in enumerate(df.columns)]
    return sums.select(F.explode(F.array(*parts)).alias("x")).select("x.*")


def inspect_files(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """(file, column, rows, missing) of several delimited files, by the names given to them."""
    found = [missing_counts(read_tsv(spark, path)).select(F.lit(name).alias("file"), "column", "rows", "missing") for name, path in files.items()]
    return reduce(DataFrame.union, found)


def id_lists(s1: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """One row per source entity with its sorted distinct ids, joined by commas, '' for none."""
    ids = F.array_join(F.array_sort(F.collect_set("candidate_entity_id")), ",")
    grouped = pairs.groupBy("source1_entity_id").agg(ids.alias(column))
    rows = s1.select(F.col("entity_id").alias("source1_entity_id")).join(grouped, "source1_entity_id", "left")
    return rows.withColumn(column, F.coalesce(column, F.lit("")))


def write_tsv(df: DataFrame, path: str, order: Column | str | None = None, one_file: bool = False) -> None:
    """Rows in `order` (a range-partitioned sort); `one_file` only for hand-over files."""
    df = df.orderBy(order) if order is not None else df
    (df.coalesce(1) if one_file else df).write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", nullValue="", quote="", escape="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def result_stats(results: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """rows, matches, singletons, average and singleton share of a result table."""
    n = F.when(F.coalesce(F.col(column), F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(column, ",")))
    sums = results.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(n), F.lit(0)).alias("matches"), F.count_if(n == 0).alias("singletons"))
    of = lambda a: F.col(a) / F.greatest(F.lit(1), F.col("rows"))
    return sums.select("*", F.round(of("matches"), 6).alias("avg_matches"), F.round(of("singletons") * 100, 4).alias("singleton_pct"))
