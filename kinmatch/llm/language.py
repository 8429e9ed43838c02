"""Language identification with error-correcting output codes.

Each language has a codeword; for each bit a binary classifier over hashed byte n-grams of the
lower-cased text separates the languages with 1 from those with 0 (log ratios of smoothed n-gram
shares, the mean over a text, scaled by a logistic fit). Decoding adds the logistic loss of each
bit, weighted by how reliable the bit was on the training rows, and takes the codeword of least
loss; a text is ambiguous if the next codeword is nearly as near.

With up to six languages the code is exhaustive (every split of the languages); with more it is
the random code of the largest least distance among seeded tries.

The classifiers are fitted on about MAX_ROWS rows and MAX_BYTES bytes at most, whole texts of up
to LONGEST bytes, as many of each language as there are up to an equal share, chosen by a hash of
the id; scoring covers whole texts of all rows.

Defined results: a null text, or one without a letter, is `und` with score 0; a very long text is
read in stretches, all of it; without training rows every text is `und`; with one language every
text with a letter is of that language; a tie of two codewords goes to the language that is first
in code point order, and is ambiguous; a null id counts as not held out; rows with equal ids are
rows of their own; rows without lang are never learned from; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_of, hash_below, map_batches, texts

BITS = 16
ORDERS = (2, 3, 4)
#: Bounds of the rows that are fitted on: rows and bytes of text in all, bytes of one text. With
#: them the bytes that a run takes differ from MAX_BYTES by some per cent at most.
MAX_ROWS = 5000
MAX_BYTES = 64 << 20
LONGEST = 128 << 10
SMOOTHING = 0.5
UNKNOWN = "und"
#: Less than this between the two nearest codewords (mean loss of a bit) is ambiguous. Of held-out
#: texts of one language 0.04 % have less, of texts made half of one and half of another 40 %.
MARGIN = 0.35
EXHAUSTIVE = 6
CHUNK = 1 << 20

_KEEP = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in range(256))


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n rows of -1 and 1, no column constant and no two columns equal or opposite."""
    if n < 2:
        return np.zeros((n, 0), dtype=np.int8)
    if n <= EXHAUSTIVE:
        splits = [(1, *c) for c in itertools.product((1, -1), repeat=n - 1) if -1 in c]
        return np.array(splits, dtype=np.int8).T
    rng, best, far = np.random.default_rng(seed), None, -1
    width = int(np.ceil(10 * np.log2(n)))
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, width))
        code = code[:, np.abs(code.sum(axis=0, dtype=int)) < n]
        near = min(int((a != b).sum()) for a, b in itertools.combinations(code, 2))
        if near > far:
            best, far = code, near
    return best


def ngrams(text: str, bits: int = BITS) -> Iterator[np.ndarray]:
    """Hashed n-grams of the whole text, a stretch at a time."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass").translate(_KEEP), dtype=np.uint8)
    for s in range(0, max(1, len(raw)), CHUNK):
        a = raw[s : s + CHUNK + max(ORDERS) - 1].astype(np.uint64)
        for n in ORDERS:
            m = min(len(a) - n + 1, CHUNK)
            if m > 0:
                code = np.full(m, n, dtype=np.uint64)
                for k in range(n):
                    code = code << np.uint64(8) | a[k : k + m]
                yield (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class Model:
    def __init__(self, langs: list[str], code: np.ndarray, table_: np.ndarray, scale: np.ndarray, shift: np.ndarray, trust: np.ndarray):
        self.langs, self.code, self.table, self.scale, self.shift, self.trust = langs, code, table_, scale, shift, trust

    def raw(self, text: str) -> np.ndarray:
        total, n = np.zeros(self.table.shape[1]), 0
        for idx in ngrams(text):
            total += self.table[idx].sum(axis=0, dtype=np.float64)
            n += len(idx)
        return total / max(n, 1)

    def decode(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether another is nearly as near."""
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, False
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        f = self.raw(text) * self.scale + self.shift
        loss = np.logaddexp(0.0, -self.code * f) @ self.trust
        order = np.argsort(loss, kind="stable")
        p = np.exp(-(loss - loss.min()) * self.code.shape[1] / 2)
        margin = float(loss[order[1]] - loss[order[0]])
        return self.langs[order[0]], float(p[order[0]] / p.sum()), margin < MARGIN


def train(rows: list[tuple[str, str]], bits: int = BITS) -> Model:
    """From (text, lang) rows."""
    rows = [(t, y) for t, y in rows if has_letter(t)]
    langs = sorted({y for _, y in rows})
    code = codewords(len(langs))
    k = code.shape[1]
    if not k:
        return Model(langs, code, np.zeros((1, 0), np.float32), np.ones(0), np.zeros(0), np.ones(0))
    at = {y: i for i, y in enumerate(langs)}
    counts = np.zeros((len(langs), 1 << bits))
    for t, y in rows:
        for idx in ngrams(t, bits):
            counts[at[y]] += np.bincount(idx, minlength=1 << bits)
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)  # each language counts alike
    smooth = SMOOTHING / max(1.0, counts.sum(axis=1).min())
    weights = np.empty((1 << bits, k), dtype=np.float32)
    for b in range(k):
        one, zero = share[code[:, b] > 0].mean(axis=0), share[code[:, b] < 0].mean(axis=0)
        weights[:, b] = np.log(one + smooth) - np.log(zero + smooth)
    model = Model(langs, code, weights, np.ones(k), np.zeros(k), np.ones(k) / k)
    raw = np.array([model.raw(t) for t, _ in rows])
    want = code[[at[y] for _, y in rows]] > 0
    trust = np.empty(k)
    for b in range(k):
        model.scale[b], model.shift[b] = _logistic(raw[:, b], want[:, b])
        wrong = np.mean((raw[:, b] * model.scale[b] + model.shift[b] > 0) != want[:, b])
        trust[b] = max(0.05, 1 - 2 * wrong)
    model.trust = trust / trust.sum()
    return model


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 1.0) -> tuple[float, float]:
    """Scale and shift by Newton's method, both sides weighing alike."""
    unit = max(float(np.abs(x).mean()), 1e-9)
    x = x / unit
    weight = np.where(y, 0.5 / max(y.sum(), 1), 0.5 / max((~y).sum(), 1)) * len(y)
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (weight * (p - y)) + ridge * w
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        w = w - np.linalg.solve(h, g)
    return float(w[0] / unit), float(w[1])


def held_out(id_: Column) -> Column:
    return crc32_of(id_) % 4 == 2


def share_of(n: int, size: int, languages: int, most: int = MAX_ROWS, most_bytes: int = MAX_BYTES) -> float:
    """The share of a language's n rows, of `size` bytes together, that are learned from."""
    return min(1.0, max(1, most // languages) / n, most_bytes / languages / max(1, size))


def training_rows(docs: DataFrame, most: int = MAX_ROWS, most_bytes: int = MAX_BYTES) -> list[tuple[str, str]]:
    size = F.octet_length("text")
    marked = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")) & (size <= LONGEST))
    stats = marked.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size")).collect()  # a row per language
    if not stats:
        return []
    chosen = [(F.col("lang") == r["lang"]) & hash_below(F.col("doc_id"), 12, share_of(r["n"], r["size"], len(stats), most, most_bytes)) for r in stats]
    rows = marked.where(reduce(lambda a, b: a | b, chosen)).select("doc_id", "text", "lang").toPandas()
    rows = rows.sort_values(["doc_id", "lang", "text"], kind="stable")
    return list(zip(rows["text"], rows["lang"]))


def identify(docs: DataFrame, model: Model, carry: tuple[str, ...] = ()) -> DataFrame:
    """_id (the doc_id), lang_pred, lang_score and ambiguous of each row, after the columns in `carry`."""
    # A model has a fixed size, 2**BITS times the bits of the code, so it may go to every task.
    parts = docs.sparkSession.sparkContext.broadcast((model.langs, model.code, model.table, model.scale, model.shift, model.trust))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), *dict.fromkeys(("text", *carry)))
    kept = [f for f in rows.schema.fields if f.name in carry]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["_id long, lang_pred string, lang_score double, ambiguous boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*parts.value)
        for b in batches:
            out = [m.decode(t.as_py()) for t in b.column("text")]
            new = [b.column("_id"), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.bool_())]
            yield pa.RecordBatch.from_arrays([b.column(f.name) for f in kept] + new, names=[f.name for f in kept] + ["_id", "lang_pred", "lang_score", "ambiguous"])

    return map_batches(rows, run, schema)


def op5_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    found = identify(docs, train(training_rows(docs)))
    return found.select(F.col("_id").alias("doc_id"), held_out(F.col("_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "ambiguous")
