"""Mixing sources to target weights by systematic sampling.

Each source has a target number of words; the expected copies of a document are the target over
the words of its source. Within a source the expected copies are summed in order, one random
offset is added, and a document is emitted once for every integer that its stretch of the sum
crosses. As the expected copies are equal within a source, the prefix sum is the rank times that
number, and ranks are taken in cells (see ranked_within), never over a whole source in a task.

The order within a source is by steps of size, an eighth of a power of two each, and by a hash
in a step, so that the copies are spread evenly over the sizes and the words taken come near
the target.

Defined results: a null or empty text has size 0 and takes 0 words; null sources are a source
of their own, last in the order of the weights; a source without words has target 0; rows with
equal ids are sampled one by one; ties of the hash go by id and size, so only rows that are equal
in these change places; of a very long text only the size is ranked; an empty table gives an empty
result; `mix` ignores other columns, whatever their names, and `sample` returns them as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ranked_within, table, word_count, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target: one row per source of (source, size) rows.

    Weights go round over the sources in code point order. A target stops at `most` times its
    source's size; what is cut off is shared by weight among the others until none is above.
    That ends where each target is min(most * size, level * weight) for one level, found by
    sorting the sources by size over weight: those below the level stop."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()  # one short row per source
    k = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighted = sources.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (k + 1).cast("int")))
    limit = F.col("source_size") * F.lit(most)
    ordered = weighted.withColumn("_r", limit / F.col("_w"))
    by = Window.orderBy("_r", F.col("source").asc_nulls_last())
    here = by.rowsBetween(Window.unboundedPreceding, -1)
    rest = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum(limit).over(here), F.lit(0.0))) / F.sum("_w").over(rest)
    leveled = ordered.withColumn("_level", level)
    open_level = F.min(F.when(F.col("_level") < F.col("_r"), F.struct("_r", "_level"))).over(everything)["_level"]
    return leveled.select("source", "source_size", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(limit, F.coalesce(open_level, F.lit(float("inf"))) * F.col("_w"))).alias("target"))


def copies(sizes: DataFrame, goals: DataFrame, seed: str = SEED) -> DataFrame:
    """Adds source_size, target and copies to (doc_id, source, size, ...) rows."""
    length = F.length(F.bin(F.col("size")))
    step = length * 16 + F.expr("shiftright(size, greatest(length(bin(size)) - 4, 0))").cast("int")
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = sizes.withColumn("_step", step).withColumn("_h", h).withColumn("_bin", F.substring("_h", 1, 2))
    facts = goals.select(
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.col("target") / F.col("source_size")).alias("_e"),
        (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce("source", F.lit(""))).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)).alias("_u"),
    )
    ranked = ranked_within(rows, ["source"], ["_step", "_bin"], [F.col("_h"), F.col("doc_id"), F.col("size")], "_rank", facts=facts)
    upto = lambda r: F.floor(r * F.col("_e") + F.col("_u"))
    return ranked.withColumn("copies", (upto(F.col("_rank")) - upto(F.col("_rank") - 1)).cast("long")).drop("_step", "_h", "_bin", "_rank", "_total", "_e", "_u")


def mix(docs: DataFrame, size: Column | None = None, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target and copies of every row of `docs`.

    `carry` names columns to take along. The texts are read once, for their sizes."""
    sizes = docs.select("doc_id", "source", (word_count(F.col("text")) if size is None else size).alias("size"), *carry)
    sizes = written(sizes, "mix-sizes")
    return copies(sizes, targets(sizes, weights, share, most), seed)


def sample(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with their own columns."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.struct("*").alias("_row"))
    drawn = copies(rows, targets(rows.select("source", "size"), weights, share, most), seed).where("copies > 0")
    return drawn.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")


def op8_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


OP8_SQL = """
with s as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
t as (select source, sum(size)::bigint as source_size from s group by source),
w as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as w from t),
r as (select *, source_size * 2.0::double as most, source_size * 2.0::double / w as r from w),
l as (
  select *, ((sum(source_size) over ())::double * 1.5::double - coalesce(sum(most) over (order by r, source nulls last rows between unbounded preceding and 1 preceding), 0))
            / sum(w) over (order by r, source nulls last rows between current row and unbounded following) as level from r),
o as (select arg_min(level, r) filter (level < r) as level from l),
g as (select source, source_size, case when source_size = 0 then 0.0::double else least(most, coalesce(o.level, 'inf'::double) * w) end as target from l, o),
k as (
  select s.*, row_number() over (partition by source order by length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)),
                                 md5('mix-1:' || coalesce(doc_id::varchar, '')), doc_id, size) as rank
  from s),
e as (
  select k.*, g.source_size, g.target, case when g.source_size = 0 then 0.0::double else g.target / g.source_size end as e,
         ('0x' || substr(md5('mix-1/' || coalesce(k.source, '')), 1, 8))::bigint::double / 4294967296.0::double as u
  from k join g on k.source is not distinct from g.source),
c as (select *, (floor(rank * e + u) - floor((rank - 1) * e + u))::bigint as copies from e)
select doc_id, size, source_size, target, copies * size as taken, source, copies from c
"""
