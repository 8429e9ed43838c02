"""The second blocker: an inverted index with posting lists cut at a length.

Hot keys are cut here to their first targets, not dropped as in `blocking`. Keys need a country.

An entity meets some thousand targets, most of them by a single key, so pairs are never shuffled:
source entities are dealt to parts, a part gets the posting lists of its keys once, and its pairs
are summed, ranked and put out entity by entity. A part is a range by country and name, so most
lists are needed by few parts, and what travels doesn't grow with the pairs.

`every_candidate` is the exact form without the two cuts: every posting of a key and every target
that an entity meets. Parts of both sides meet where they have a country in common, and a key's
targets in a part are bits, so that hot keys cost no more than their bits.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..workspace import discard, written

# executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The weight of each family of keys.
WEIGHTS = {"exact_name": 8, "exact_addr": 7, "combo": 6, "name_prefix": 5, "name_tok": 4, "addr_tok": 3, "ngram": 2}


def posting_keys() -> Column:
    """Distinct (family, key) of a normalised entity, without its country."""
    name, addr = F.col("name_norm"), F.col("address_norm")
    words = lambda c: F.regexp_extract_all(c, F.lit("[a-z0-9]+"), F.lit(0))
    toks, atoks = words(name), words(addr)
    of = lambda family, keys: F.transform(keys, lambda k: F.struct(F.lit(family).alias("family"), k.alias("key")))
    if_ = lambda cond, key: F.when(cond, F.array(key)).otherwise(F.array().cast("array<string>"))
    numeric = F.get(F.filter(atoks, lambda t: t.rlike("[0-9]")), F.lit(0))
    grams = F.when(F.length(name) >= 3, F.transform(F.sequence(F.lit(1), F.length(name) - 2), lambda i: F.substring(name, i, F.lit(3)))).otherwise(F.array().cast("array<string>"))
    prefix = F.substring(F.get(toks, F.lit(0)), 1, 4)
    combo = F.concat(prefix, F.lit("\x01"), F.coalesce(numeric, F.get(atoks, F.lit(0))))
    return F.array_distinct(
        F.concat(
            of("exact_name", if_(name != "", name)),
            of("exact_addr", if_(addr != "", addr)),
            of("name_tok", F.filter(toks, lambda t: F.length(t) >= 2)),
            of("name_prefix", if_(F.size(toks) > 0, prefix)),
            of("addr_tok", F.filter(atoks, lambda t: F.length(t) >= 3)),
            of("ngram", grams),
            of("combo", if_((F.size(toks) > 0) & (F.size(atoks) > 0), combo)),
        )
    )


def postings(entities: DataFrame, *carry: str) -> DataFrame:
    rows = entities.where(F.coalesce("country_norm", F.lit("")) != "").select("entity_id", "country_norm", *carry, F.explode(posting_keys()).alias("k"))
    return rows.select("entity_id", F.col("country_norm").alias("country"), "k.family", "k.key", *carry)


def cut(index: DataFrame, order: list[str], most: int, by: tuple[str, ...] = ("family", "country", "key")) -> DataFrame:
    """The first `most` postings of each key; Spark limits each partition before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return index.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most).drop("rn")


#: Source entities of a part, at most about: its posting lists are held in a task's memory.
PART = 8_000
#: Postings that are summed at once.
CHUNK = 1_000_000
_ON = ("h1", "h2")
_FORM = ("country_norm", "name_norm", "address_norm")


def _hashes(family: Column, key: Column) -> list[Column]:
    """128 bits of hash in place of the three strings that postings meet on."""
    on = (family, F.col("country_norm"), key)
    return [F.xxhash64(*on).alias("h1"), F.xxhash64(F.lit(1), *on).alias("h2")]


def _forms(entities: DataFrame, *carry: str) -> DataFrame:
    """What keys are made of, of the entities that have a country. Keys are many times as wide, so
    they are made where they are used and no table or shuffle of entities holds them."""
    return entities.where(F.coalesce("country_norm", F.lit("")) != "").select("entity_id", *_FORM, *carry).distinct()


def _count_of_parts(entities: DataFrame) -> int:
    n, cores = entities.count(), entities.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-n // PART), min(cores, n // 500))


def _exploded(entities: DataFrame, *columns: str) -> DataFrame:
    """A row a key. The explode is an outer one, as for a plain one Spark adds a filter on the keys,
    and makes them once more for it, below the shuffle of the entities."""
    keyed = entities.select(*columns, "country_norm", posting_keys().alias("keys"))
    return keyed.select(*columns, "country_norm", F.explode_outer("keys").alias("k")).where("k is not null")


def _lists(target: DataFrame, order: list[str], most: int) -> DataFrame:
    """The cut index, a row a key: hashes, weight, positions of targets in `order`, their ids."""
    numbered = written(_forms(target, *order).orderBy(*order).select("entity_id", *_FORM, F.monotonically_increasing_id().alias("n")), "numbered")
    weight = F.element_at(F.create_map(*[x for k, v in WEIGHTS.items() for x in (F.lit(k), F.lit(v).cast("long"))]), F.col("k.family"))
    # narrow rows are dealt anew, as a task would read far more of them than it can hold the keys of;
    # by country and name, so that most of a key's postings are cut before the shuffle
    near = numbered.repartitionByRange(_count_of_parts(numbered), "country_norm", "name_norm", "n")
    index = _exploded(near, "entity_id", "n").select("entity_id", "n", weight.alias("w"), *_hashes(F.col("k.family"), F.col("k.key")))
    rows = cut(index, ["n"], most, _ON).groupBy(*_ON).agg(F.first("w").alias("w"), F.collect_list(F.struct("n", "entity_id")).alias("x"))
    return rows.select(*_ON, "w", F.col("x.n").alias("ns"), F.col("x.entity_id").alias("ids"))


def _in_parts(s1: DataFrame) -> tuple[DataFrame, int]:
    """Source entities with their parts, and how many parts there are. A part is a range by country
    and name, with all rows of an entity: its entities share their keys, so few parts need a list."""
    entities = written(_forms(s1).groupBy("entity_id").agg(F.collect_set(F.struct(*_FORM)).alias("forms")), "entities")
    parts = _count_of_parts(entities)
    near = entities.withColumn("first", F.array_min("forms")).repartitionByRange(parts, "first.country_norm", "first.name_norm", "entity_id")
    left = written(near.select(F.spark_partition_id().alias("part"), "entity_id", F.inline("forms")), "source")
    discard(entities)
    return left, parts


def _dealt(s1: DataFrame, target: DataFrame, order: list[str], most: int) -> DataFrame:
    """By part: the lists that its keys need, once each (no entity), then its entities in order."""
    left, parts = _in_parts(s1)
    wanted = _exploded(left.repartitionById(parts, F.col("part")), "part").select("part", *_hashes(F.col("k.family"), F.col("k.key"))).groupBy(*_ON).agg(F.collect_set("part").alias("parts"))
    lists = _lists(target, order, most).join(wanted, list(_ON)).select(F.explode("parts").alias("part"), *_ON, "w", "ns", "ids")
    return lists.unionByName(left, allowMissingColumns=True).repartitionById(parts, F.col("part")).sortWithinPartitions("part", F.col("entity_id").asc_nulls_first())


def _matched(s1: DataFrame, target: DataFrame, order: list[str], most: int, top: int | None) -> DataFrame:
    dealt = _dealt(s1, target, order, most).withColumn("keys", posting_keys())
    hashes = lambda i: F.transform("keys", lambda k: _hashes(k["family"], k["key"])[i])
    rows = dealt.select("part", "entity_id", *[F.when(F.col("entity_id").isNull(), F.array(h)).otherwise(hashes(i)).alias(h) for i, h in enumerate(_ON)], "w", "ns", "ids")
    return rows.mapInArrow(lambda batches: _pairs(batches, top), "source1_entity_id string, candidate_entity_id string, position long, score long")


def _flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Lengths of the lists of a column, and what is in them."""
    return column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), column.flatten()


class _Part:
    """The posting lists of a part, by hash, and its candidates in the targets' order."""

    def __init__(self, rows: list[pa.RecordBatch]):
        t = pa.Table.from_batches(rows)
        column = lambda c: t.column(c).combine_chunks()
        h1, h2 = (_flat(column(c))[1].to_numpy() for c in _ON)
        by = np.lexsort((h2, h1))
        lengths, ns = _flat(column("ns"))
        self.h1, self.h2, self.w, self.length, self.start = h1[by], h2[by], column("w").to_numpy()[by], lengths[by], (np.cumsum(lengths) - lengths)[by]
        self.position, first, self.candidate = np.unique(ns.to_numpy(), return_index=True, return_inverse=True)
        self.ids = column("ids").flatten().take(pa.array(first))

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The list of each key, -1 for none."""
        at, last = np.searchsorted(self.h1, h1), len(self.h1) - 1
        while True:
            here = np.minimum(at, last)
            same = (at <= last) & (self.h1[here] == h1)
            other = same & (self.h2[here] != h2)  # 64 bits alike, not all 128
            if not other.any():
                return np.where(same, here, -1)
            at = at + other

    def pairs(self, entities: list[str], owner: np.ndarray, lists: np.ndarray, top: int | None) -> pa.RecordBatch:
        """The pairs of some entities: `owner` and `lists` have a row for each of their keys."""
        lengths = self.length[lists]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.start[lists] - ends + lengths, lengths)
        n, wide = len(self.position), int(max(WEIGHTS.values())) + 1
        code = np.sort((np.repeat(owner, lengths) * n + self.candidate[at]) * wide + np.repeat(self.w[lists], lengths))
        pair = code // wide
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        score, pair = np.add.reduceat(code - pair * wide, first), pair[first]
        owner, candidate = pair // n, pair % n
        if top is not None:
            by = np.lexsort((candidate, -score, owner))
            begins = np.flatnonzero(np.diff(owner, prepend=-1))
            rank = np.arange(len(by)) - np.repeat(begins, np.diff(begins, append=len(by)))
            by = by[rank < top]
            owner, candidate, score = owner[by], candidate[by], score[by]
        names = pa.array(entities, pa.string()).take(pa.array(owner))
        return pa.RecordBatch.from_arrays([names, self.ids.take(pa.array(candidate)), pa.array(self.position[candidate]), pa.array(score)], ["source1_entity_id", "candidate_entity_id", "position", "score"])


def _pairs(batches: Iterator[pa.RecordBatch], top: int | None) -> Iterator[pa.RecordBatch]:
    """Rows come by part: its lists first (no entity), then its entities in order."""
    number, lists, part = None, [], None
    entities, owner, found, held = [], [], [], 0

    def done():
        nonlocal entities, owner, found, held
        if held:
            yield part.pairs(entities, np.concatenate(owner), np.concatenate(found), top)
        entities, owner, found, held = [], [], [], 0

    for batch in batches:
        numbers, ids = batch.column("part").to_numpy(), batch.column("entity_id")
        lone = ids.is_null().to_numpy(zero_copy_only=False)
        # runs of rows of a part and a kind
        bounds = [0, *(np.flatnonzero((np.diff(numbers) != 0) | (np.diff(lone.astype(np.int8)) != 0)) + 1).tolist(), len(numbers)]
        for a, b in zip(bounds, bounds[1:]):
            if a == b:
                continue
            if numbers[a] != number:
                yield from done()
                number, lists, part = numbers[a], [], None
            run = batch.slice(a, b - a)
            if lone[a]:
                lists.append(run)
                continue
            if not lists and part is None:
                continue  # no key of the part is in the index
            if part is None:
                part, lists = _Part(lists), []
            lengths, h1 = _flat(run.column("h1"))
            hits = part.find(h1.to_numpy(), run.column("h2").flatten().to_numpy())
            ends = np.cumsum(lengths)
            for name, begin, end in zip(ids.slice(a, b - a).to_pylist(), (ends - lengths).tolist(), ends.tolist()):
                mine = hits[begin:end]
                mine = mine[mine >= 0]
                size = int(part.length[mine].sum())
                if not size:
                    continue
                if not entities or entities[-1] != name:
                    if held + size > CHUNK:
                        yield from done()
                    entities.append(name)
                owner.append(np.full(len(mine), len(entities) - 1))
                found.append(mine)
                held += size
    yield from done()


def scored(s1: DataFrame, target: DataFrame, order: list[str], most: int = S.DEFAULT.max_postings) -> DataFrame:
    """Pairs with the sum of the weights of their shared keys, and the target's position in `order`."""
    return _matched(s1, target, order, most, None)


def candidates(s1: DataFrame, target: DataFrame, order: list[str], settings: S.Settings = S.DEFAULT) -> DataFrame:
    """The best `max_per_entity` pairs of each source entity, ties by the targets' order."""
    return _matched(s1, target, order, settings.max_postings, settings.max_per_entity).select(*S.PAIR)


class _Whole(_Part):
    """The uncut posting lists of some targets, by hash; those of hot keys as bits."""

    def __init__(self, rows: list[pa.RecordBatch]):
        t = pa.Table.from_batches(rows)
        names = t.column("entity_id").combine_chunks()
        codes = names.dictionary_encode()
        self.ids, row = codes.dictionary, codes.indices.to_numpy()
        lengths, h1 = _flat(t.column("h1").combine_chunks())
        h1, h2, candidate = h1.to_numpy(), _flat(t.column("h2").combine_chunks())[1].to_numpy(), np.repeat(row, lengths)
        by = np.lexsort((h2, h1))
        h1, h2, self.candidate = h1[by], h2[by], candidate[by]
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        self.start = np.flatnonzero(new)
        self.length = np.diff(self.start, append=len(h1))
        self.h1, self.h2 = h1[self.start], h2[self.start]
        wide = -(-len(self.ids) // 64) * 64
        hot = np.flatnonzero(self.length > wide // 64)
        self.hot = np.full(len(self.start), -1)
        self.hot[hot] = np.arange(len(hot))
        self.bits = np.empty((len(hot), wide // 64), np.uint64)
        for k, x in enumerate(hot.tolist()):
            mark = np.zeros(wide, bool)
            mark[self.candidate[self.start[x] : self.start[x] + self.length[x]]] = True
            self.bits[k] = np.packbits(mark).view(np.uint64)

    def met(self, lists: np.ndarray) -> np.ndarray:
        """The targets in any of the lists, once each."""
        hot = self.hot[lists]
        mark = np.unpackbits(np.bitwise_or.reduce(self.bits[hot[hot >= 0]], axis=0).view(np.uint8))
        rest = lists[hot < 0]
        lengths = self.length[rest]
        ends = np.cumsum(lengths)
        if len(rest):
            mark[self.candidate[np.arange(ends[-1]) + np.repeat(self.start[rest] - ends + lengths, lengths)]] = 1
        return np.flatnonzero(mark)


def _every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block: its targets first, then its source entities in order."""
    number, targets, part = None, [], None
    name, lists = None, []
    entities, found, held = [], [], 0

    def close():
        """The pairs of the entity whose rows have been read."""
        nonlocal name, lists, held
        if lists:
            entities.append(name)
            found.append(part.met(np.concatenate(lists)))
            held += len(found[-1])
        name, lists = None, []

    def done():
        nonlocal entities, found, held
        if held:
            owner = np.repeat(np.arange(len(entities)), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([pa.array(entities, pa.string()).take(pa.array(owner)), part.ids.take(pa.array(np.concatenate(found)))], list(S.PAIR))
        entities, found, held = [], [], 0

    for batch in batches:
        numbers, source = batch.column("block").to_numpy(), batch.column("source").to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero((np.diff(numbers) != 0) | (np.diff(source.astype(np.int8)) != 0)) + 1).tolist(), len(numbers)]
        for a, b in zip(bounds, bounds[1:]):
            if a == b:
                continue
            if numbers[a] != number:
                close()
                yield from done()
                number, targets, part = numbers[a], [], None
            run = batch.slice(a, b - a)
            if not source[a]:
                targets.append(run)
                continue
            if part is None:
                part, targets = _Whole(targets), []
            if not len(part.h1):
                continue  # no target of the block has a key
            lengths, h1 = _flat(run.column("h1"))
            hits = part.find(h1.to_numpy(), run.column("h2").flatten().to_numpy())
            ends = np.cumsum(lengths)
            for x, begin, end in zip(run.column("entity_id").to_pylist(), (ends - lengths).tolist(), ends.tolist()):
                if x != name:
                    close()
                    if held > CHUNK:
                        yield from done()
                    name = x
                mine = hits[begin:end]
                mine = mine[mine >= 0]
                if len(mine):
                    lists.append(mine)
    close()
    yield from done()


def _fewer(entities: DataFrame, parts: int) -> DataFrame:
    """Neighbouring parts as one where Spark made more than asked for: an entity goes to as many
    blocks as there are parts on the other side."""
    made = (entities.agg(F.max("part")).first()[0] or 0) + 1
    return entities.withColumn("part", F.floor(F.col("part") * parts / made).cast("int")) if made > parts else entities


def every_candidate(s1: DataFrame, target: DataFrame) -> DataFrame:
    """All distinct pairs that share a key, however many postings it has and however many targets an
    entity meets. An entity is in one part of its side, so a pair is found in one block."""
    left, right = _fewer(*_in_parts(s1)), _fewer(*_in_parts(target))
    countries = lambda df, side: df.select(F.col("part").alias(side), "country_norm").distinct()
    blocks = countries(left, "i").join(countries(right, "j"), "country_norm").select("i", "j").distinct()
    blocks = written(blocks.coalesce(1).select("i", "j", F.monotonically_increasing_id().alias("block")), "blocks")
    of = lambda df, side: df.join(F.broadcast(blocks), F.col("part") == F.col(side)).select(F.col("block"), F.lit(side == "i").alias("source"), "entity_id", *_FORM)
    dealt = of(right, "j").unionByName(of(left, "i")).repartitionById(max(1, blocks.count()), F.col("block").cast("int")).sortWithinPartitions("block", "source", "entity_id").withColumn("keys", posting_keys())
    hashes = lambda i: F.transform("keys", lambda k: _hashes(k["family"], k["key"])[i])
    return dealt.select("block", "source", "entity_id", *[hashes(i).alias(h) for i, h in enumerate(_ON)]).mapInArrow(_every, "source1_entity_id string, candidate_entity_id string")
