"""Classifiers, near-duplicates, packing, media, pages and the pipeline, with odd rows."""

import hashlib
import itertools
import os
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from kinmatch.llm import common, components, html_main, language, matroska, near_dup, packing, quality_model

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, **more):
    return spark.createDataFrame([(k, t, None, "s", 0) for k, t in enumerate(texts)], DOCS)


# --- classifiers -------------------------------------------------------------------------------


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs_ = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    weights, bias = quality_model.train(quality_model.training_rows(docs_, labels, most=1500))
    rows = labels.where(quality_model.held_out(F.col("doc_id"))).join(quality_model.score(docs_, weights, bias), "doc_id").collect()
    right = [(r.score >= 0.3) == bool(r.quality) for r in rows]
    assert len(rows) > 500 and np.mean(right) > 0.97


def test_quality_of_odd_rows(spark):
    weights, bias = quality_model.train([("good words here", 1), ("$$$ %%%", 0)] * 20)
    got = {r.doc_id: r.score for r in quality_model.score(docs(spark, [None, "", " \n", "good words here", "$$$ %%%"]), weights, bias).collect()}
    assert got[0] == got[1] == got[2] and got[3] > got[0] > got[4]
    assert quality_model.train([])[1] == 0.0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_model.training_rows(docs(spark, ["x"]), none) == []
    assert quality_model.score(docs(spark, []), weights, bias).count() == 0


def test_quality_of_clashing_and_repeated_rows(spark):
    weights, bias = quality_model.train([("good words here", 1), ("$$$ %%%", 0)] * 20)
    long = "good words here " * 100_000
    df = spark.createDataFrame([(None, "good words", "x"), (1, "$$$", "x"), (1, "$$$", "y"), (2, long, "z")], "doc_id long, text string, score string").withColumn("quality", F.col("score"))
    got = sorted((r.doc_id or -1, r.score) for r in quality_model.score(df, weights, bias).collect())
    assert [k for k, _ in got] == [-1, 1, 1, 2] and got[1] == got[2] and got[3][1] > 0.5
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, 7), (2, None), (2, 1)], "doc_id long, quality int").withColumn("text", F.lit("clash"))
    learned = quality_model.training_rows(df, labels)
    assert Counter((t, y) for t, y in learned if t == "$$$") == ({("$$$", 0): 2, ("$$$", 1): 2} if zlib.crc32(b"1") % 5 else {})


def plain_ftrl(rows, epochs):
    """Follow the regularised leader with dictionaries, a weight at a time."""
    q = quality_model
    z, n, bz, bn = defaultdict(float), defaultdict(float), 0.0, 0.0

    def weight(i):
        return 0.0 if abs(z[i]) <= q.L1 else -(z[i] - np.sign(z[i]) * q.L1) / ((q.BETA + n[i] ** 0.5) / q.ALPHA + q.L2)

    order = np.random.default_rng(1)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            text, y = rows[k]
            x = {int(i): float(np.float32(v)) for i, v in zip(*q.features(text))}
            w = {i: weight(i) for i in x}
            b = -bz / ((q.BETA + bn**0.5) / q.ALPHA)
            d = 1 / (1 + np.exp(-(sum(w[i] * v for i, v in x.items()) + b))) - y
            for i, v in x.items():
                z[i] += d * v - ((n[i] + (d * v) ** 2) ** 0.5 - n[i] ** 0.5) / q.ALPHA * w[i]
                n[i] += (d * v) ** 2
            bz += d - ((bn + d * d) ** 0.5 - bn**0.5) / q.ALPHA * b
            bn += d * d
    return {i: weight(i) for i in z}, -bz / ((q.BETA + bn**0.5) / q.ALPHA)


def test_ftrl_by_hand(spark):
    rng = random.Random(2)
    words = "a bb ccc dd# ee $$ ff gg".split()
    rows = [(" ".join(rng.choices(words[4 * y : 4 * y + 5], k=rng.randint(0, 9))), y) for y in (0, 1) for _ in range(15)]
    weights, bias = quality_model.train(rows)
    want, plain_bias = plain_ftrl(rows, quality_model.EPOCHS)
    assert bias == pytest.approx(plain_bias, rel=1e-4) and sum(map(bool, want.values())) > 10
    for i, w in want.items():
        assert weights[i] == pytest.approx(w, rel=1e-3, abs=1e-5)
    assert np.count_nonzero(weights) <= len(want)
    for r in quality_model.score(docs(spark, [t for t, _ in rows]), weights, bias).collect():
        x = dict(zip(*quality_model.features(rows[r.doc_id][0])))
        assert r.score == pytest.approx(1 / (1 + np.exp(-(sum(want.get(int(i), 0.0) * v for i, v in x.items()) + plain_bias))), abs=1e-3)


def test_language_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(language.training_rows(df))
    found = language.identify(df, model, ("lang",)).where(language.held_out(F.col("_id"))).collect()
    assert len(found) > 200 and np.mean([r.lang == r.lang_pred for r in found]) > 0.97


def test_language_of_odd_rows(spark):
    rows = [("the cat sat on the mat", "en"), ("le chat est sur la table", "fr"), ("der Hund ist im Haus", "de")] * 5
    model = language.train(rows)
    df = docs(spark, [None, "", "123 !!", "the cat on the mat", "der Hund im Haus", "der Hund im Haus " * 100_000])
    clash = df.withColumns({c: F.lit("clash") for c in ("lang_pred", "_id", "lang_score", "ambiguous")})
    got = [r.lang_pred for r in language.identify(clash, model).orderBy("_id").collect()]
    assert got == ["und", "und", "und", "en", "de", "de"]
    twice = spark.createDataFrame([(None, "der Hund", "de", "s", 0), (1, "the cat", None, "s", 0), (1, "the cat", "en", "s", 0)], DOCS)
    assert Counter((r._id, r.lang_pred) for r in language.identify(twice, model).collect()) == {(None, "de"): 1, (1, "en"): 2}
    assert sorted(language.training_rows(twice)) == [("der Hund", "de"), ("the cat", "en")]
    assert language.train([]).decode("text") == ("und", 0.0, False)
    assert language.train([("ein Text", "de")]).decode("some text") == ("de", 1.0, False)
    assert language.identify(docs(spark, []), model).count() == 0
    assert language.training_rows(docs(spark, ["x"])) == []


@pytest.mark.parametrize("n", [10**3, 10**7, 10**10, 10**12])
def test_share_of_training_rows(spark, n):
    """The share stays what it should be, however many rows there are."""
    share = language.share_of(n, n * 2000, 4)
    assert share * n == pytest.approx(min(n, 1250))
    # ids of which about 2**64 * share lie below the bound
    bound = int(share * 2.0**64) - 2**63 if share < 1 else 2**63
    assert (bound + 2**63) / 2.0**64 * n == pytest.approx(min(n, 1250), rel=1e-6)
    wide = spark.range(100_000).where(common.hash_below(F.col("id"), 12, 0.01)).count()
    assert 800 < wide < 1200


def test_bytes_of_training_rows(spark):
    assert common.within_bytes([(5, 10), (1, 10), (3, 10)], 30) is None
    assert common.within_bytes([(5, 10), (1, 10), (3, 10)], 25) == 3
    assert common.within_bytes([(5, 100)], 25) < 5
    df = spark.createDataFrame([(k, "word " * 200, "en", "s", 0) for k in range(400)], DOCS)
    rows = language.training_rows(df, most_bytes=100_000)
    assert 50_000 < sum(len(t) for t, _ in rows) < 150_000
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, quality int")
    assert sum(len(t) for t, _ in quality_model.training_rows(df, labels, most_bytes=100_000)) <= 100_000


def test_mixed_texts_are_ambiguous(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(language.training_rows(df))
    rows = [r for r in df.where(language.held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang").collect() if language.has_letter(r.text)]
    assert np.mean([model.decode(r.text)[2] for r in rows]) < 0.01
    rng, mixed = random.Random(3), []
    for _ in range(200):
        a, b = rng.choice(rows), rng.choice(rows)
        if a.lang != b.lang:
            x, y = a.text.split(), b.text.split()
            n = min(len(x), len(y))
            mixed.append(model.decode(" ".join(x[:n] + y[:n]))[2])
    assert np.mean(mixed) > 0.25


def test_decoding_by_hand():
    """The nearest codeword by the weighted logistic loss, bit by bit."""
    rng = random.Random(7)
    said = {"aa": "abc abd abe", "bb": "xyz xyw xyv", "cc": "mno mnp mnq", "dd": "rst rsu rsv"}
    model = language.train([(" ".join(rng.choices(v.split(), k=6)), k) for k, v in said.items() for _ in range(5)])
    for t in ["abc xyz", "mno", "rst rsu abc", "xyv xyw", "qqq"]:
        grams = Counter(int(i) for part in language.ngrams(t) for i in part)
        raw = [sum(n * float(model.table[i, b]) for i, n in grams.items()) / sum(grams.values()) for b in range(model.code.shape[1])]
        losses = []
        for word in model.code:
            losses.append(sum(w * np.log1p(np.exp(-int(c) * (r * s + h))) for c, r, s, h, w in zip(word, raw, model.scale, model.shift, model.trust)))
        best = min(range(4), key=lambda k: losses[k])
        lang, _, ambiguous = model.decode(t)
        assert lang == model.langs[best]
        assert ambiguous == (sorted(losses)[1] - min(losses) < language.MARGIN)


@pytest.mark.parametrize("n", [2, 3, 4, 6, 9, 20])
def test_codewords(n):
    code = language.codewords(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1, 1}
    near = min(int((a != b).sum()) for a, b in itertools.combinations(code, 2))
    assert near >= (1 if n == 2 else 2 if n == 3 else 4)


# --- near-duplicates -----------------------------------------------------------------------------


def plain_simhash(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash():
    for t in [None, "", "one", "Two WORDS", "Ärger ÄRGER ärger x", "a b c d e f a b c", "x y z w\tq\n\nr"]:
        assert near_dup.simhash(t) == plain_simhash(t)


def brute_components(prints, radius=2):
    root = dict(enumerate(range(len(prints))))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(prints)), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= radius:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(k) for k in range(len(prints))]


@pytest.mark.parametrize("seed", [1, 3, 64])
def test_links_lose_nothing(spark, seed):
    """Clusters, chains and a dense ball."""
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for seed in prints[:6]:
        x = seed
        for _ in range(12):
            x ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.append(x)
    prints += [prints[0] ^ (1 << k) for k in range(64)]
    prints = list(dict.fromkeys(prints))
    want = defaultdict(set)
    for k, r in enumerate(brute_components(prints)):
        want[r].add(near_dup._signed(prints[k]))
    df = spark.createDataFrame([(near_dup._signed(x),) for x in prints], "fp long")
    roots = {r.node: r.root for r in components.components(near_dup.links(df)).collect()}
    got = defaultdict(set)
    for x in prints:
        got[roots.get(near_dup._signed(x), near_dup._signed(x))].add(near_dup._signed(x))
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_links_are_all_pairs(spark):
    """A hot block value: thousands of fingerprints that differ in the bits of two blocks alone."""
    rng = random.Random(9)
    base = rng.getrandbits(64)
    prints = list({base ^ rng.getrandbits(11) ^ rng.getrandbits(3) << 11 for _ in range(3000)} | {rng.getrandbits(64) for _ in range(100)})
    got = {(r.a, r.b) for r in near_dup.links(spark.createDataFrame([(near_dup._signed(x),) for x in prints], "fp long")).collect()}
    known = set(prints)
    flips = [1 << j for j in range(64)] + [1 << j | 1 << k for j in range(64) for k in range(j)]
    want = {tuple(sorted((near_dup._signed(x), near_dup._signed(x ^ f)))) for x in prints for f in flips if x ^ f in known}
    assert got == want and len(want) > 10_000


def test_groups_are_bounded_by_construction():
    for agreed in near_dup.block_masks():
        free = 64 - bin(agreed).count("1")
        assert free <= 22
        for m in near_dup.part_masks(agreed):
            assert m & agreed == agreed and 64 - bin(m).count("1") <= 6


def test_components_of_a_star(spark):
    """A node with 100,000 neighbours."""
    df = spark.range(1, 100_001).selectExpr("id as u", "if(id % 2 = 0, 0, 200000) as v").union(spark.createDataFrame([(200_000, 5), (5, 0)], "u long, v long"))
    got = components.components(df)
    assert got.count() == 100_001 and got.select("root").distinct().collect() == [(0,)]


def test_keep_first_of_clashing_columns(spark):
    rows = [(1, "a b c d", "x"), (2, "a b c d", "y"), (3, "e f g h", "z"), (4, "i j k l", "u"), (4, "i j k l", "v"), (None, "a b c d", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string").selectExpr("*", "_id as _mark", "_id as later", "_id as fp", "_id as component_id")
    got = near_dup.keep_first(df)
    assert got.columns == df.columns
    kept = sorted((r.doc_id or -1, r._id, r._mark) for r in got.collect())
    assert [x[0] for x in kept] == [-1, 1, 3, 4] and all(a == b for _, a, b in kept)
    assert near_dup.keep_first(df.where("doc_id < 4")).count() == 2
    long = spark.createDataFrame([(1, "w " * 300_000), (2, "w " * 300_000)], "doc_id long, text string")
    assert [r.doc_id for r in near_dup.keep_first(long).collect()] == [1]


def test_components_of_a_long_chain(spark):
    df = spark.range(300).selectExpr("id as u", "id + 1 as v")
    assert {r.root for r in components.components(df).collect()} == {0}


def test_near_duplicates_of_odd_rows(spark):
    rows = [(5, None), (3, ""), (9, "a b c d"), (9, "a b c d"), (2, "A B c d"), (None, "a b c d"), (None, "other words here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = Counter((r.doc_id, r.component_id) for r in near_dup.near_duplicates(df).collect())
    assert got == {(5, 3): 1, (3, 3): 1, (9, 2): 2, (2, 2): 1, (None, 2): 1, (None, None): 1}
    assert near_dup.near_duplicates(df.limit(0)).count() == 0
    kept = near_dup.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id or -1 for r in kept) == [-1, -1, 2, 3]


# --- packing -----------------------------------------------------------------------------------


def test_packing_is_exact(spark):
    path, ranks = packing.vocabulary()
    texts = [None, "", "Hello wörld", "日本語 text", "a  b\t\tc \n\n d", "<|endoftext|> x", "it's 12345 ok… ", "x y " * 5000, "   z", *["word " * k for k in range(1, 400, 7)]]
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs(spark, texts), path, ranks).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for k, t in enumerate(texts):
        ids = struct.pack(f"<{(n := len(x := plain.encode(t or '', add_special_tokens=False).ids + [1]))}I", *x)
        at = 0
        for r in sorted(by[k], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == n and r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == n
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for held_ in windows.values():
        at = 0
        for offset, length in sorted(held_):
            assert offset == at
            at += length
        assert at <= 2048


def test_encoders_agree(spark):
    path, ranks = packing.vocabulary()
    fast, exact = packing.encoder(path, ranks), packing.encoder(path, None)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(300).collect()]
    rng = random.Random(2)
    pool = [chr(c) for c in [*range(9, 14), *range(32, 127), *range(161, 592)]] + [" ", " ", "'s", "\n"]
    texts += ["".join(rng.choice(pool) for _ in range(200)) for _ in range(300)]
    assert all(fast(t) == exact(t) for t in texts)


def test_best_fit_is_bounded_and_tight():
    rng = random.Random(1)
    lengths = [rng.randint(1, 2048) for _ in range(5000)]
    window, offset, left = packing.best_fit(lengths)
    assert len(left) <= packing.OPEN
    assert sum(lengths) / (2048 * (max(window) + 1)) > 0.95
    assert packing.best_fit([]) == ([], [], [])


def plain_best_fit(lengths, length, most_open):
    """Every open window looked at for each piece."""
    opened, out, n = [], [], 0
    for x in lengths:
        fits = [w for w in opened if w[1] + x <= length]
        if fits:
            w = max(fits, key=lambda w: (w[1], -w[0]))
        else:
            if len(opened) >= most_open:
                opened.remove(max(opened, key=lambda w: (w[1], -w[0])))
            w = [n, 0]
            opened.append(w)
            n += 1
        out.append((w[0], w[1]))
        w[1] += x
        if w[1] == length:
            opened.remove(w)
    return out, sorted(w[0] for w in opened)


@pytest.mark.parametrize("most_open", [1, 2, 5, 64])
def test_best_fit_by_hand(most_open):
    rng = random.Random(most_open)
    for longest in (30, 100):
        lengths = [rng.randint(1, longest) for _ in range(700)]
        window, offset, left = packing.best_fit(lengths, 100, most_open)
        assert (list(zip(window, offset)), sorted(left)) == plain_best_fit(lengths, 100, most_open)


def test_packing_merges_leftovers(spark):
    """Two steps by hand: each partition on its own, then the open windows of MERGE partitions."""
    rng = random.Random(8)
    rows = [(k, 0, n, k * 7, n, 0) for k in range(4000) for n in [rng.randint(1, 900)]]
    df = spark.createDataFrame(rows, packing.PIECES)
    got = {r.doc_id: r for r in packing.pack(df, 4000, 1000, 8).collect()}
    parts = -(-4000 // packing.ROWS)
    dealt = df.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens", "turn", F.lit(9)), F.lit(parts))).orderBy("doc_id").collect()
    by = defaultdict(list)
    for r in dealt:
        by[r.part].append(r)
    left = defaultdict(list)
    for p, held_ in by.items():
        placed, opened = plain_best_fit([r.length for r in held_], 1000, 8)
        fill = Counter()
        for r, (w, at) in zip(held_, placed):
            fill[w] += r.length
            if w not in opened:
                assert (got[r.doc_id].sequence_id, got[r.doc_id].offset) == (p << 32 | w, at)
        left[p // packing.MERGE] += [(fill[w], p, w) for w in opened]
    for m, opened in left.items():
        opened.sort(key=lambda x: (-x[0], x[1], x[2]))
        placed, _ = plain_best_fit([x[0] for x in opened], 1000, len(opened) + 1)
        base = {(p, w): to for (_, p, w), to in zip(opened, placed)}
        for p, held_ in by.items():
            if p // packing.MERGE == m:
                where, still = plain_best_fit([r.length for r in held_], 1000, 8)
                for r, (w, at) in zip(held_, where):
                    if w in still:
                        to, start = base[p, w]
                        assert (got[r.doc_id].sequence_id, got[r.doc_id].offset) == ((parts + m) * 2**32 + to, start + at)


def test_packing_of_odd_rows(spark):
    rows = [(None, "same words"), (None, "same words"), (None, None), (1, "a"), (1, "a"), (1, "b")] + [(None, "again")] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("start", "length", "part", "turn", "window", "sequence_id")})
    got = packing.pack_documents(df.repartition(3))
    assert got.count() == len(rows)
    spread = packing.pieces(df, *packing.vocabulary()).where("doc_tokens > 1").groupBy("doc_id", "ids_crc32", "turn").count()
    assert spread.agg(F.max("count")).first()[0] <= df.rdd.getNumPartitions()
    for _, held_ in itertools.groupby(sorted((r.sequence_id, r.offset, r.length) for r in got.collect()), key=lambda x: x[0]):
        at = 0
        for _, offset, length in held_:
            assert offset == at
            at += length
        assert at <= packing.LENGTH


def test_packing_of_an_empty_table(spark):
    assert packing.pack_documents(docs(spark, [])).count() == 0


# --- media ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 9, 10, 11, 200, 700])
def test_matroska_round_trip(n):
    rng = random.Random(n)
    payload = rng.randbytes(matroska.UNIT * n)
    media = matroska.mux(payload)
    m = matroska.demux(media)
    assert b"".join(media[p.byte_start : p.byte_start + p.byte_size] for p in m.packets) == payload
    assert [c[2] for c in m.cues] == [at for at, _ in m.clusters] and m.duration_ms == len(payload) / 8
    at = 0
    for p in m.packets:
        assert p.timestamp_ms == pytest.approx(at / 8)
        at += p.byte_size
    assert m.tracks[1]["codec"] == "A_PCM/INT/LIT"


def test_matroska_of_unknown_sizes_and_groups():
    """A live stream: segment and cluster of unknown size, and a block group."""
    media = matroska.mux(b"\x07" * matroska.UNIT)
    head = media[: media.index(b"\x18\x53\x80\x67")]
    inner = media[media.index(b"\x15\x49\xa9\x66") : media.index(b"\x1f\x43\xb6\x75")]
    block = matroska._element(matroska.BLOCK, b"\x81\x00\x05\x00" + b"abc")
    cluster = b"\x1f\x43\xb6\x75\x01\xff\xff\xff\xff\xff\xff\xff" + matroska._uint(matroska.TIMESTAMP, 10) + matroska._element(matroska.BLOCK_GROUP, block)
    m = matroska.demux(head + b"\x18\x53\x80\x67\x01\xff\xff\xff\xff\xff\xff\xff" + inner + cluster + cluster)
    assert [p.timestamp_ms for p in m.packets] == [15.0, 15.0] and len(m.clusters) == 2


def test_matroska_refuses_other_bytes():
    with pytest.raises(ValueError):
        matroska.demux(b"RIFF....")
    with pytest.raises(ValueError):
        matroska.mux(b"")


def test_stored_media(spark):
    texts = [None, "", "é" * 288, "x" * 577, "x" * 577, "z" * 100_000]
    df = docs(spark, texts).withColumn("media", F.lit("clash"))
    got = {r.doc_id: r for r in matroska.digest(matroska.store(df)).collect()}
    for k, t in enumerate(texts):
        n, payload = matroska.payload_of(t)
        r = got[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert got[3][2:] == got[4][2:] and got[0][1:] == got[1][1:]
    assert matroska.digest(matroska.store(docs(spark, []))).count() == 0
    assert matroska.packet_table(matroska.store(docs(spark, texts))).where("doc_id = 3").count() == 2


# --- pages -----------------------------------------------------------------------------------------


def page(k, extra=""):
    return f"""<!doctype html><html><head><title>t{k}</title><style>p{{}}</style><script>var a="</p><article>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li>Home<li>News {k}</ul></nav><div class="notice">cookies {k}</div>
<article><h1>Title&nbsp;{k} &amp; more</h1><p>First <b>bold</b>
 text<br>line<p>Second &lt;{k}&gt;<div class=ad>buy {k}</div><ul><li>one<li>two</ul><section class="comments"><p>reader {k}</section></article>{extra}
<aside>side {k}</aside><form><input><p>mail</p></form><footer>&copy; {k}</footer></body></html>"""


def test_pages(spark):
    rows = [(k, f"https://h{k % 2}.example/{k}", page(k)) for k in range(20)]
    rows += [(90, None, None), (91, "x", ""), (92, "http://one.example/", "<p>alone <i>text</i>"), (93, "//h0.example", page(3)[:700]), (5, "https://h1.example/5", page(5))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = defaultdict(list)
    for r in html_main.extract(df).collect():
        got[r.page_id].append(r)
        assert r.n_chars == len(r.text)
    want = lambda k: f"Title {k} & more\nFirst bold text line\nSecond <{k}>\none\ntwo"
    for k in range(20):
        assert {r.text for r in got[k]} == {want(k)}
    assert [got[k][0].text for k in (90, 91, 92)] == ["", "", "alone text"] and len(got[5]) == 2
    assert got[93][0].text.startswith("Title 3 & more\nFirst bold text line")
    assert html_main.extract(df.limit(0)).count() == 0


def test_template_texts_without_article(spark):
    rows = [(k, "http://h/x", f"<body><div id=top>Our great site</div><div id=story><p>story {k} words</p></div><div id=end>All rights</div></body>") for k in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    t = html_main.templates(df).first()
    assert t.n_pages == 9 and len(t.texts) == 2 and t.body is None
    assert {r.text for r in html_main.extract(df).collect()} == {f"story {k} words" for k in range(9)}


def test_occurrence_vectors(spark):
    """Sums tell vectors apart as the vectors themselves do."""
    rng = random.Random(4)
    rows = [(k, "http://h/", "<body>" + "<div><hr></div>" * rng.randint(1, 3) + "<section></section>" * rng.randint(0, 2) + "</body>") for k in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    vectors = defaultdict(lambda: [0] * 12)
    for k, _, h in rows:
        for t, _ in html_main.read_page(h)[0]:
            vectors[t][k] += 1
    sums = {r.token: (r.pages, r.total, r.low, r.high) for r in html_main.occurrences(df).groupBy("token").agg(*[F.sum(c).alias(c) for c in ("pages", "total", "low", "high")]).collect()}
    for a, b in itertools.combinations(vectors, 2):
        assert (vectors[a] == vectors[b]) == (sums[a] == sums[b])


# --- pipeline --------------------------------------------------------------------------------------


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "quality rules", "SimHash near-dedup", "mixing sources to target weights", "packing"]
    df = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in df.collect()}
    now = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF)
        assert out.columns == df.columns
        assert all(before[r.doc_id] == r for r in out.collect())
        if name == "SimHash near-dedup":
            prints = sorted((r.doc_id, plain_simhash(r.text)) for r in now.collect())
            roots = brute_components([p for _, p in prints])
            assert {r.doc_id for r in out.collect()} == {prints[k][0] for k, r in enumerate(roots) if r == k}
        now = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert pieces.agg(F.sum("length")).first()[0] == sum(len(packing.encoder(packing.vocabulary()[0], None)(r.text)) // 4 + 1 for r in now.collect())


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, columns with clashing names."""
    rng = random.Random(11)
    words = {"en": "the cat sat on a mat with some of those other things".split(), "fr": "le chat est sur la table avec quelques autres choses".split()}
    said = lambda lang, n: " ".join(f"{rng.choice(words[lang])}{rng.randint(0, 99)}" for _ in range(n))
    rows = [(k, said(lang, 60), lang, f"s{k % 3}", 0) for k in range(40) for lang in [("en", "fr")[k % 2]]]
    copy_ = rows[7][1]
    rows += [(100, None, None, None, None), (101, "", "en", "s0", 0), (102, "123 456 " * 20, "en", "s0", 0), (103, "few words", "en", None, 0)]
    rows += [(104, copy_, "fr", None, 3), (105, copy_.upper(), None, "s1", 3), (None, said("en", 50), "en", "s1", 0), (None, said("en", 50), "en", None, 0)]
    rows += [(106, long := said("fr", 30_000), "fr", "s2", 0), (107, same := said("en", 40), "en", "s2", 0), (107, same, "en", "s2", 0)]
    df = spark.createDataFrame(rows, DOCS)
    clash = df.withColumns({c: F.lit("clash") for c in ("_id", "_mark", "size", "copies", "target", "lang_pred", "failure_bits", "fp", "start", "turn", "_row")})
    clash.write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in pieces}
    assert ids <= {k for k, *_ in rows} - {100, 101, 102, 103, 104, 105}
    assert 7 in {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df.where("doc_id in (7, 104, 105)"), "").collect()}
    kept, now = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:3]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == list(corpus_pipeline.COLUMNS)
        kept.append(Counter(r.doc_id for r in now.collect()))
    assert 100 not in kept[0] and 102 not in kept[0] and 103 not in kept[1] and kept[1][None] == 2
    assert kept[2] == Counter([*range(40), 106, 107, None, None])
    held = defaultdict(int)
    for r in pieces:
        held[r.doc_id] += r.length
        assert r.length <= packing.LENGTH
    n = len(packing.encoder(packing.vocabulary()[0], None)(long)) // 4 + 1
    assert held[106] % n == 0 and held[106] // n <= 2


def test_nothing_else_imports_this_package():
    top = os.path.dirname(os.path.dirname(corpus_pipeline.__file__ and os.path.abspath(html_main.__file__)))
    for folder, _, files in os.walk(top):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f), encoding="utf-8") as text:
                    assert "llm" not in text.read(), f
