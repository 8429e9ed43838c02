"""Quality classifier: logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

Features of a text are its tokens (runs of word characters, runs of other non-space characters),
their pairs and triples, and, under one name of its own, how many triples the text has had before.
They are hashed into 2**BITS weights and scaled to unit length, whatever the length of the text.

The model is fitted on about MAX_ROWS labelled rows and MAX_BYTES bytes of their texts at most,
chosen by a hash of the id; everything else, scoring above all, covers whole texts of all rows.

Defined results: a null or empty text has no features, so its score is that of the bias; a very
long text is one sparse vector like any other; equal texts have equal scores; a null id counts as
held out; rows with equal ids are scored one by one; without labelled rows every score is 0.5;
labels other than 0 and 1 are ignored, and rows with several labels are used with each; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_of, hash_below, hash_of, map_batches, table, texts, within_bytes

BITS = 18
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
#: Bounds of the labelled rows that are fitted on: rows, and bytes of their texts.
MAX_ROWS = 8_000
MAX_BYTES = 64 << 20
THRESHOLD = 0.3

_TOKEN = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^\s0-9A-Za-z_\x80-\xff]+")


def features(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Indices (each once) and values; empty for a text without tokens."""
    tokens = _TOKEN.findall((text or "").encode("utf-8", "surrogatepass"))
    h = np.fromiter(map(zlib.crc32, tokens), dtype=np.uint64, count=len(tokens))
    parts = [h * np.uint64(0x9E3779B97F4A7C15)]
    if len(h) > 1:
        pair = (h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[1:]) * np.uint64(0x9E3779B97F4A7C15)
        parts.append(pair)
    if len(h) > 2:
        triple = pair[:-1] * np.uint64(0x165667B19E3779F9) + h[2:]
        again = len(triple) - len(np.unique(triple))
        parts.append(triple * np.uint64(0xFF51AFD7ED558CCD))
        parts.append(np.full(again, 0xD6E8FEB86659FD93, dtype=np.uint64))
    index = (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64)
    index, count = np.unique(index, return_counts=True)
    value = count.astype(np.float64)
    return index, value / max(np.sqrt((value * value).sum()), 1e-12)


def train(rows: list[tuple[str | None, int]], bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias by FTRL-proximal with one learning rate per weight."""
    n = 1 << bits
    z, g2 = np.zeros(n), np.zeros(n)
    bz = bn = 0.0
    data = [(i.astype(np.int32), v.astype(np.float32), y) for (i, v), y in ((features(t, bits), y) for t, y in rows)]
    order = np.random.default_rng(1)

    def weight(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(epochs):
        for k in order.permutation(len(data)):
            index, value, y = data[k]
            zi, ni = z[index], g2[index]
            w = weight(zi, ni)
            b = -bz / ((BETA + bn**0.5) / ALPHA)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ value + b, -35, 35)))
            g = (p - y) * value
            z[index] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            g2[index] = ni + g * g
            d = p - y
            bz += d - ((bn + d * d) ** 0.5 - bn**0.5) / ALPHA * b
            bn += d * d
    return weight(z, g2), float(-bz / ((BETA + bn**0.5) / ALPHA))


def held_out(id_: Column) -> Column:
    return crc32_of(id_) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_ROWS, most_bytes: int = MAX_BYTES) -> list[tuple[str | None, int]]:
    """About `most` labelled rows and `most_bytes` bytes of text at most, none of them held out,
    the same on each run. First the sizes of the chosen rows are looked at, then texts are moved."""
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id"), "quality")
    n = marked.count()
    if not n:
        return []
    share = lambda c: hash_below(F.col(c), 11, most / n)
    # the same filter by id on both sides keeps the texts that are moved to the bound
    some = docs.where(share("doc_id")).select("doc_id", "text", hash_of(F.col("doc_id"), 11).alias("h"))
    some = some.join(marked.where(share("_id")), F.col("doc_id") == F.col("_id"))
    sizes = some.select("h", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).collect()
    last = within_bytes([(r["h"], r["n"]) for r in sizes], most_bytes)
    rows = (some if last is None else some.where(F.col("h") <= last)).select("doc_id", "text", "quality").toPandas()
    rows = rows.sort_values(["doc_id", "quality", "text"], kind="stable")
    return list(zip(rows["text"], rows["quality"].astype(int)))


def score(docs: DataFrame, weights: np.ndarray, bias: float, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of each row."""
    # A model has a fixed size, 2**BITS weights, so it may be sent to every task.
    model = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = model.value
        for batch in batches:
            out = np.empty(batch.num_rows)
            for k, t in enumerate(batch.column(1)):
                index, value = features(t.as_py(), bits)
                out[k] = 1.0 / (1.0 + np.exp(-np.clip(w[index] @ value + b, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["doc_id", "score"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, score double")


def op1_hashed_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    weights, bias = train(training_rows(docs, table(spark, sf_dir, "labels")))
    scored = score(docs, weights, bias)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
