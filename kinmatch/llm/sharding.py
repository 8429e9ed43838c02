"""Sharding by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked; row r of a source of n rows gets
the fractional rank (r - 0.5) / n; all rows are sorted by it and cut into shards whose row
counts differ by one at most. Any stretch of that order holds each source in its share of the
whole, so every shard matches the mixture.

Both ranks are taken in cells (see ranked_within): first (source, hash prefix), then even slices
of the fractional rank, which the construction fills evenly however large one source is.

Defined results: a null text has size 1 and checksum 0; null sources are a source of their own;
ties of the hash go by id, checksum and size, so only rows that are equal in all of them change
places; rows with equal ids are sharded one by one; ids may be null; of a very long text only size
and checksum are kept; an empty table gives an empty result; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_of, ranked_within, table, written

SLICES = 4096
SEED = "shard-1"


def interleave(docs: DataFrame, shards: int, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, text_crc32, source, shard (from 0) and slot in the shard (from 0)."""
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        crc32_of(text).alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("_h"),
    ).withColumn("_bin", F.substring("_h", 1, 3))
    rows = ranked_within(rows, ["source"], ["_bin"], [F.col(c) for c in ("_h", "doc_id", "text_crc32", "size")], "_rank")
    rows = rows.select("doc_id", "source", "size", "text_crc32", "_rank", ((F.col("_rank") - F.lit(0.5)) / F.col("_total")).alias("_f"))
    rows = written(rows, "shard-ranks")
    rows = rows.withColumn("_slice", F.floor(F.col("_f") * SLICES).cast("int")).withColumn("_all", F.lit(0))
    order = [F.col("_f"), F.col("source").asc_nulls_last(), F.col("_rank")]
    placed = ranked_within(rows, ["_all"], ["_slice"], order, "_pos").withColumn("_pos", F.col("_pos") - 1)
    n = F.col("_total")
    first = F.floor((F.col("shard") * n + (shards - 1)) / F.lit(shards))
    return (
        placed.withColumn("shard", F.floor(F.col("_pos") * shards / n).cast("int"))
        .withColumn("slot", (F.col("_pos") - first).cast("long"))
        .select("doc_id", "size", "text_crc32", "source", "shard", "slot")
    )


def op3_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = interleave(table(spark, sf_dir, "documents"), 16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


# DuckDB has no CRC-32, so the SQL builds its table (polynomial 0xEDB88320) and goes over the bytes.
OP3_SQL = """
with bytes as (
  select list(v order by i) as t
  from (select i, list_reduce([i] || range(8), lambda a, x: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v from (select unnest(range(256)) as i))),
d as (
  select doc_id, source, strlen(coalesce(text, ''))::bigint + 1 as size, md5('shard-1:' || coalesce(doc_id::varchar, '')) as h,
         xor(list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint),
                         lambda a, b: xor(a >> 8, bytes.t[(xor(a, b) & 255) + 1])), 4294967295)::bigint as text_crc32
  from documents, bytes),
r as (select *, row_number() over (partition by source order by h, doc_id nulls first, text_crc32, size) as rank, count(*) over (partition by source) as total from d),
f as (select *, (rank - 0.5::double) / total as f from r),
p as (select *, row_number() over (order by f, source nulls last, rank) - 1 as pos, count(*) over () as n from f),
s as (select *, floor(pos * 16 / n)::int as shard from p)
select doc_id, size, text_crc32, 'rows' as law, shard, (pos - (shard::bigint * n + 15) // 16)::bigint as slot, null::int as grown_shard, source from s
"""
