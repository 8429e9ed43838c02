"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..workspace import discard, spread, written  # noqa: F401

#: What separates words: the ASCII white space.
WORD_SPACE = " \t\n\x0b\x0c\r"
WORD_SPACE_CLASS = "[\\x20\\x09-\\x0D]"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table whose texts are worked on row by row, at some cost: small files go to all cores."""
    return spread(table(spark, sf_dir, name))


def map_batches(rows: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow. Spark ends a batch at 64 MB (maxBytesPerBatch) or 10,000 rows, whichever comes
    first, and the session's settings stay as the caller left them."""
    return rows.mapInArrow(run, schema)


def hash_below(id_: Column, salt: int, share: float) -> Column:
    """Whether a hash of the id falls into `share` of all 64-bit numbers. The bound is a 64-bit
    number as well, so that a share of some rows out of 10**12 still is more than none."""
    if share >= 1:
        return F.lit(True)
    return hash_of(id_, salt) < F.lit(int(share * 2.0**64) - 2**63)


def hash_of(id_: Column, salt: int) -> Column:
    return F.xxhash64(id_.cast("long"), F.lit(salt))


def within_bytes(sizes: list[tuple[int, int]], most: int) -> int | None:
    """For (hash, bytes) of rows: the largest hash up to which all rows together have at most
    `most` bytes, or None if all rows do."""
    if sum(n for _, n in sizes) <= most:
        return None
    last, total = -(2**63), 0
    by_hash: dict[int, int] = {}
    for h, n in sizes:
        by_hash[h] = by_hash.get(h, 0) + n
    for h in sorted(by_hash):
        total += by_hash[h]
        if total > most:
            return last
        last = h
    return last


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, which is computed once however often `body` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text as an array, empty for a null text."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(WORD_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPACE_CLASS + "+"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def ranked_within(rows: DataFrame, group: list[str], bins: list[str], order: list[Column], rank: str, total: str = "_total", facts: DataFrame | None = None) -> DataFrame:
    """Adds `rank` (from 1) of each row in its `group`, sorted by `bins` and then by `order`,
    the number of the group's rows as `total`, and the columns of `facts`, a row per group.

    No task holds a whole group: rows meet only within one (group, bins), a count of each
    such cell is summed over the cells before it, and the rank in the cell is added. Nulls in
    `group` form a group of their own; `bins` aren't null. The keys that are joined on are
    those of the window, and never null, so that rows are shuffled once for both."""
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = rows.select("*", *[key(c).alias(f"_g_{c}") for c in group])
    if facts is not None:
        facts = facts.select(*[key(c).alias(f"_f__g_{c}") for c in group], *[c for c in facts.columns if c not in group])
    group = [f"_g_{c}" for c in group]
    keys = group + bins
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_in_cell"))
    before = Window.partitionBy(*group).orderBy(*bins).rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        F.coalesce(F.sum("_in_cell").over(before), F.lit(0)).alias("_before"),
        F.sum("_in_cell").over(Window.partitionBy(*group)).alias(total),
    )
    if facts is not None:  # joined to the cells, which are few, not to the rows
        cells = cells.join(facts, [F.col(f"_c_{g}") == F.col(f"_f_{g}") for g in group]).drop(*[f"_f_{g}" for g in group])
    here = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.join(cells, [F.col(k) == F.col(f"_c_{k}") for k in keys], "inner")
        .withColumn(rank, F.col("_before") + F.row_number().over(here))
        .drop("_before", *group, *[f"_c_{k}" for k in keys])
    )


def crc32_of(value: Column) -> Column:
    """Unsigned CRC-32 of a value's text in UTF-8, null as the empty text."""
    return F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary"))
