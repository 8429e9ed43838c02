"""Bounded-space online packing of token sequences.

Documents become pieces: full windows of the length, and a remainder. Each partition keeps a
fixed number of open windows; a piece goes where it fits best; where none fits, the fullest is
emitted and a new one opened. What is open at a partition's end is merged: the leftovers of
MERGE partitions are packed like pieces, whole window by whole window.

Token ids come from the `tokenizers` vocabulary file named by `path`. Texts in which each
character is a letter, digit or mark of the Latin blocks or ordinary ASCII space go through the
`ranks` form of the same vocabulary, which gives the same ids at a fifth of the time; all others
go through `tokenizers` itself (tests compare the two, README has the figures).

Pieces are dealt to partitions by a hash of what they are, so reruns and lost executors give the
same windows. Repeated rows, which a hash would deal to one partition, are told apart by their
count in the input partition that they are read in.

Defined results: a null or empty text is a document of the end id alone; a very long text is as
many pieces as it needs; rows with equal ids are packed one by one; ids may be null; of windows
that fit equally well the one opened first is taken, and of equally full ones the one opened first
is emitted; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, texts, written

LENGTH = 2048
OPEN = 64
END_ID = 1
#: Rows of documents for each partition of the first step, and partitions for each of the second.
ROWS = 750
MERGE = 8

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, turn long"
#: Characters on which both forms of the vocabulary split alike.
PLAIN = r"[\t\n\x0b\x0c\r\x20-\x7e\xa1-ɏ]*"


def encoder(path: str, ranks: str | None) -> Callable[[str], bytes]:
    """Text to ids, as little-endian unsigned 32-bit integers."""
    import numpy as np
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    marks = [x.content for x in whole.get_added_tokens_decoder().values()]
    exact = lambda t: np.array(whole.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
    if not ranks:
        return exact
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    plain = re.compile(PLAIN)

    def encode(t: str) -> bytes:
        if plain.fullmatch(t) and not any(m in t for m in marks):
            return np.array(fast.encode_ordinary(t), dtype="<u4").tobytes()
        return exact(t)

    return encode


def pieces(docs: DataFrame, path: str, ranks: str | None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Rows of PIECES: each document's ids, with the end id, in pieces of at most `length`. `turn`
    is 0, but for a repeat of a document in its input partition a number of its own."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(path, ranks)
        seen: dict[tuple, int] = {}
        here = TaskContext.get().partitionId()
        for b in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                known = (doc_id, zlib.crc32(ids), n)
                turn = seen[known] = seen.get(known, -1) + 1
                if turn:
                    turn = here << 32 | turn
                for s in range(0, n, length):
                    part = ids[4 * s : 4 * (s + length)]
                    for col, x in zip(out, (doc_id, s, len(part) // 4, zlib.crc32(part), n, turn)):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=[x.split()[0] for x in PIECES.split(", ")])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, PIECES)


def best_fit(lengths: list[int], length: int = LENGTH, most_open: int = OPEN) -> tuple[list[int], list[int], list[int]]:
    """For each item its window and offset there; the windows that are open at the end."""
    window, offset = [0] * len(lengths), [0] * len(lengths)
    free: list[tuple[int, int]] = []  # (room, window) of open windows, sorted
    n = 0
    for i, x in enumerate(lengths):
        k = bisect.bisect_left(free, (x, -1))
        if k < len(free):
            room, w = free.pop(k)
        else:
            if len(free) >= most_open:
                free.pop(0)
            room, w, n = length, n, n + 1
        window[i], offset[i] = w, length - room
        if room > x:
            bisect.insort(free, (room - x, w))
    return window, offset, [w for _, w in free]


def pack(rows: DataFrame, n_docs: int, length: int = LENGTH, most_open: int = OPEN) -> DataFrame:
    """PIECES rows with sequence_id and offset."""
    parts = max(1, -(-n_docs // ROWS))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens", "turn", F.lit(9)), F.lit(parts)))

    def first(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["doc_id", "doc_tokens", "start", "ids_crc32", "turn"], kind="stable", na_position="first")
        window, offset, left = best_fit(g["length"].tolist(), length, most_open)
        return g.assign(window=window, offset=offset, open=pd.Series(window, index=g.index).isin(left))

    packed = dealt.groupBy("part").applyInPandas(first, f"{PIECES}, part long, window long, offset long, open boolean")
    packed = written(packed, "packed")
    left = packed.where("open").groupBy("part", "window").agg(F.sum("length").alias("fill")).withColumn("merge", F.floor(F.col("part") / MERGE))

    def second(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["fill", "part", "window"], ascending=[False, True, True])
        window, base, _ = best_fit(g["fill"].tolist(), length, len(g) + 1)
        return pd.DataFrame({"part": g["part"], "window": g["window"], "to": (parts + g["merge"]) * 2**32 + window, "base": base})

    merged = left.groupBy("merge").applyInPandas(second, "part long, window long, to long, base long").withColumnsRenamed({"part": "_part", "window": "_window"})
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    closed = packed.where("not open").select(*columns, (F.col("part") * F.lit(2**32) + F.col("window")).alias("sequence_id"), "offset")
    moved = packed.where("open").join(merged, (F.col("part") == F.col("_part")) & (F.col("window") == F.col("_window")))
    return closed.union(moved.select(*columns, F.col("to").alias("sequence_id"), (F.col("offset") + F.col("base")).alias("offset")))


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def pack_documents(docs: DataFrame, path: str | None = None, ranks: str | None = None, length: int = LENGTH) -> DataFrame:
    if path is None:
        path, ranks = vocabulary()
    return pack(pieces(docs, path, ranks, length), docs.count(), length)


def op9_bounded_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(texts(spark, sf_dir))
