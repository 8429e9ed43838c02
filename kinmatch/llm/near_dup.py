"""SimHash near-duplicates, searched with pivot distance tables.

Fingerprints: words lower-cased in A-Z, shingles of three words with their repeats, XXH64 of
each shingle with seed 42; a bit of the fingerprint is 1 if it is set in over half the hashes.

Search, over distinct fingerprints only, so copies cost nothing. Two fingerprints within RADIUS
bits agree on at least four of six blocks, so those that share no choice of four blocks with
another are out. For the others the table of Hamming distances to PIVOTS reference fingerprints is
computed, once each. In the bits that a choice leaves free the same argument is used again: eight
parts, of which six agree. What meets on six parts differs in six bits at most, so a group has at
most 64 members by construction, however dense the fingerprints lie, and a choice of four blocks
at most 2**22. Of the pairs in a group those whose distances to any pivot differ by more than
RADIUS are discarded (triangle inequality), and the rest are verified bit by bit. There is no
other way for large or small groups. Links go to connected components.

Defined results: a null text, or one without words, has fingerprint zero, which links like any
other; a very long text is fingerprinted whole, in stretches; fewer than three words are one
shingle; rows with equal ids are fingerprinted one by one; ids that are null don't count as the
smallest; a component whose ids are all null has a null component_id; an empty table gives an
empty result; other columns are ignored by near_duplicates and kept by keep_first, whatever their
names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, texts, written
from .components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
PIVOTS = 16
BLOCKS = (11, 11, 11, 11, 10, 10)
AGREE = len(BLOCKS) - RADIUS
PARTS = 8


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: XXH64 of the numbers from 0, as signed 64-bit integers."""
    import xxhash

    return [_signed(xxhash.xxh64_intdigest(str(k).encode(), 7)) for k in range(n)]


def _stretches(bits: list[int], widths: list[int]) -> list[int]:
    """Masks of consecutive stretches of `bits`, which are bit numbers."""
    ends = list(itertools.accumulate(widths))
    return [sum(1 << b for b in bits[e - w : e]) for w, e in zip(widths, ends)]


def block_masks() -> list[int]:
    """For each choice of AGREE blocks the mask of their bits, unsigned."""
    return [sum(c) for c in itertools.combinations(_stretches(list(range(64)), list(BLOCKS)), AGREE)]


def part_masks(agreed: int) -> list[int]:
    """All bits but those of two parts of what `agreed` leaves free, for each two parts."""
    free = [b for b in range(64) if not agreed >> b & 1]
    widths = [len(free) // PARTS + (k < len(free) % PARTS) for k in range(PARTS)]
    return [(1 << 64) - 1 - sum(c) for c in itertools.combinations(_stretches(free, widths), RADIUS)]


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a text as an unsigned integer."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) >= shingle else iter([b" ".join(words)])
    hashes = np.fromiter(map(xxh64_intdigest, parts, itertools.repeat(seed)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, n, 8192):  # bounds the memory of very long texts
        ones += np.unpackbits(hashes[k : k + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of each row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([_signed(simhash(t.as_py())) for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, "doc_id long, fp long")


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of all distinct fingerprints of `fps` (one column fp, distinct) that
    are within RADIUS bits of each other."""
    masks = block_masks()
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])
    met = fps.select("fp", F.posexplode(keys).alias("c", "k")).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("c", "k")))
    met = written(met.where("n > 1").select("fp", "c"), "met")

    distances = F.array(*[_apart(F.col("fp"), F.lit(p)).cast("byte") for p in pivots()])
    near = written(met.select("fp").distinct().select(F.col("fp").alias("_fp"), distances.alias("d")), "pivot-table")
    parts = F.array(*[F.array(*[F.lit(_signed(m)) for m in part_masks(agreed)]) for agreed in masks])
    groups = met.join(near, F.col("fp") == F.col("_fp")).select("fp", "d", "c", F.posexplode(F.transform(F.get(parts, F.col("c")), lambda m: m.bitwiseAND(F.col("fp")))).alias("s", "k"))
    groups = groups.groupBy("c", "s", "k").agg(F.sort_array(F.collect_list(F.struct("fp", "d"))).alias("x")).where(F.size("x") > 1)

    def within(a: Column, b: Column) -> Column:
        discarded = F.exists(F.zip_with(a["d"], b["d"], lambda x, y: F.abs(x - y)), lambda apart: apart > RADIUS)
        return ~discarded & (_apart(a["fp"], b["fp"]) <= RADIUS)

    close = F.flatten(F.transform("x", lambda a: F.transform(F.filter("x", lambda b: (a["fp"] < b["fp"]) & within(a, b)), lambda b: F.struct(a["fp"].alias("a"), b["fp"].alias("b")))))
    return groups.select(F.explode(close).alias("p")).select("p.a", "p.b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp and component_id, one row per row of `docs`."""
    rows = written(fingerprints(docs, id_col, text_col), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(fps.select("fp")))
    whole = roots.union(roots.select("root", "root").distinct()).toDF("node", "root")
    # A component may hold a third of the fingerprints, and a fingerprint a third of the rows. What
    # is joined on them is written before, so that both sides are plain scans and AQE can split
    # the rows of such a key over many tasks.
    named = written(whole.join(fps, F.col("node") == F.col("fp")).select("node", "root", "least"), "named")
    least = written(named.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "_root"), "least")
    linked = named.join(least, F.col("root") == F.col("_root")).select("node", "component_id")
    classes = fps.join(linked, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("_fp"), F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(written(classes, "classes"), F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that remain when each component keeps the row of its smallest id.

    Rows with equal ids count as one document, which goes if any of them is a later member of a
    component, and else leaves one row; rows without an id can't be named and all remain. Texts
    are moved once, for the join with the ids that are marked, or not at all where these are so
    few that Spark sends them to every task."""
    found = near_duplicates(docs, id_col, text_col).where("doc_id is not null")
    marks = found.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") != F.col("component_id")).alias("later"), (F.count(F.lit(1)) > 1).alias("again"))
    name = "_mark"
    while name in docs.columns:
        name += "_"
    marks = written(marks.where("later or again").select(F.struct("doc_id", "later", "again").alias(name)), "marks")
    joined = docs.join(marks, docs[id_col].cast("long") == marks[name]["doc_id"], "left")
    once = joined.where(F.col(name).isNull()).drop(name)
    if marks.where(F.col(name)["again"] & ~F.col(name)["later"]).isEmpty():
        return once
    first = joined.where(F.col(name)["again"] & ~F.col(name)["later"]).dropDuplicates([id_col]).drop(name)
    return once.union(first)


def op7_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(texts(spark, sf_dir))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
