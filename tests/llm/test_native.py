"""Rule ledger, sharding, mixing and chat formatting, with odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinmatch.llm import chat, mixing, quality_rules, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, s, 0) for i, t, s in rows], DOCS)


def some_texts():
    rng = random.Random(3)
    words = ["a", "b", "c", "dd", "ééé", "#x", "Z", "|"]
    texts = [" ".join(rng.choice(words[: rng.randint(1, 8)]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    lines = ["\n".join(rng.choice(["x y", "x y ", "", " \t", "long line of words"]) for _ in range(rng.randint(1, 20))) for _ in range(20)]
    return [None, "", " \n\t ", "one", "a b c d e", "a b c d e a b c d e", "a b c", "x " * 30_000, *texts, *lines]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    wins = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    held = set()
    for i in range(len(words) - 4):
        if wins[tuple(words[i : i + 5])] > 1:
            held.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(held)


def test_measurements(spark):
    texts = some_texts()
    got = {r.doc_id: r for r in quality_rules.ledger(docs(spark, [(k, t, "s") for k, t in enumerate(texts)])).collect()}
    for k, t in enumerate(texts):
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t), t
        assert bool(r.failure_bits & 1) == (r.n_words < 10)


def test_ledger_of_odd_tables(spark):
    empty = docs(spark, [])
    assert quality_rules.ledger(empty).count() == 0
    assert quality_rules.ablations(quality_rules.ledger(empty)).where("n_failed > 0").count() == 0
    odd = docs(spark, [(None, "x", None), (1, "y", "s"), (1, "y", "s")]).withColumn("n_words", F.lit("clash"))
    assert quality_rules.ledger(odd).count() == 3


def test_ablations(spark):
    texts = ["short", "a b c d e " * 20, " ".join(f"w{k}" for k in range(50)), " ".join(f"w{k}##" for k in range(50))]
    rows = {r.rule: r for r in quality_rules.ablations(quality_rules.ledger(docs(spark, [(k, t, "s") for k, t in enumerate(texts)]))).collect()}
    assert rows["few_words"].n_docs == 4 and rows["few_words"].n_kept == 1
    assert (rows["few_words"].n_failed, rows["few_words"].n_only_this, rows["few_words"].n_kept_without) == (1, 1, 2)
    assert rows["symbols_per_word"].bits_in_all == quality_rules.BIT["symbols_per_word"]


def rows_of(n, hot=0.4):
    rng = random.Random(5)
    return [(k, f"text {k % 7} " * rng.randint(0, 30), None if k % 11 == 0 else "hot" if rng.random() < hot else f"s{k % 5}") for k in range(n)]


@pytest.mark.parametrize("n", [0, 1, 5, 16, 333])
def test_shards(spark, n):
    rows = rows_of(n)
    got = sharding.interleave(docs(spark, rows), 16).collect()
    assert len(got) == n
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        text = (rows[r.doc_id][1] or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by[k]) for k in range(16)]
    assert max(sizes) - min(sizes) <= 1
    share = Counter(s for _, _, s in rows)
    for source, count in share.items():
        held = Counter(r.shard for r in got if r.source == source)
        assert all(abs(held[k] - count / 16) <= 2 for k in range(16))


def test_shards_again_and_repeats(spark):
    df = docs(spark, rows_of(60) + rows_of(20))
    assert sorted(sharding.interleave(df, 4).collect()) == sorted(sharding.interleave(df.repartition(5), 4).collect())


@pytest.mark.parametrize("n", [1, 7, 200])
def test_shards_by_hand(spark, n):
    rows = rows_of(n)
    by = defaultdict(list)
    for k, t, source in rows:
        by[source].append((hashlib.md5(f"shard-1:{k}".encode()).hexdigest(), k))
    order = sorted(((r + 0.5) / len(v), source is None, source or "", r, k) for source, v in by.items() for r, (_, k) in enumerate(sorted(v)))
    shard = {x[-1]: pos * 16 // n for pos, x in enumerate(order)}
    first = {s: min(pos for pos, x in enumerate(order) if shard[x[-1]] == s) for s in shard.values()}
    slot = {x[-1]: pos - first[shard[x[-1]]] for pos, x in enumerate(order)}
    for r in sharding.interleave(docs(spark, rows), 16).collect():
        assert (r.shard, r.slot) == (shard[r.doc_id], slot[r.doc_id])


def test_shards_of_odd_rows(spark):
    rows = [(None, None, None), (None, None, None), (1, "x", "a"), (1, "x", "a"), (1, "y", None), (2, "long " * 200_000, "b")]
    clash = docs(spark, rows).withColumns({c: F.lit("clash") for c in ("shard", "slot", "size", "_h", "_rank", "_total", "_bin")})
    got = sharding.interleave(clash, 4).collect()
    assert sorted(r.shard for r in got) == [0, 0, 1, 2, 2, 3] and sorted(r.size for r in got) == [1, 1, 2, 2, 2, 1_000_001]


def water(sizes, weights):
    """Targets by giving and sharing out the excess, step by step."""
    total = 1.5 * sum(sizes.values())
    target, full = dict.fromkeys(sizes, 0.0), set()
    left = total
    while left > 1e-9 and len(full) < len(sizes):
        w = sum(weights[s] for s in sizes if s not in full)
        excess = 0.0
        for s in [s for s in sizes if s not in full]:
            target[s] += left * weights[s] / w
        for s in list(sizes):
            if s not in full and target[s] >= 2 * sizes[s]:
                excess += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                full.add(s)
        left = excess
    return target


def test_mix(spark):
    rows = rows_of(400)
    got = mixing.mix(docs(spark, rows)).collect()
    sizes = defaultdict(int)
    for r in got:
        assert r.size == len(WORD.findall(rows[r.doc_id][1] or ""))
        sizes[r.source] += r.size
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = water(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], rel=0.1)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs(spark, rows).repartition(3)).collect()))


def test_mix_of_odd_tables(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    got = mixing.mix(docs(spark, [(1, None, "a"), (2, "", "a"), (None, "x y", None), (None, "x y", None)])).collect()
    assert {(r.doc_id, r.size, r.target) for r in got if r.source == "a"} == {(1, 0, 0.0), (2, 0, 0.0)}
    assert sum(r.copies for r in got if r.source is None) == 3
    clash = docs(spark, [(k, "x y z", "a") for k in range(10)]).withColumns({c: F.lit(c) for c in ("size", "target", "copies", "_h")})
    drawn = mixing.sample(clash)
    assert drawn.count() == 15 and drawn.columns == clash.columns and drawn.where("size <> 'size' or copies <> 'copies'").count() == 0


TURNS = "conv_id long, turn long, role string, text string"


def talk(turns):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_round_trip(spark):
    rng = random.Random(8)
    bits = ["<|end|>", "<|new user|>", "\\l", "\\", "[INST]", "</s>", "|>", "a|b", "é", "\n", "word ", "\\z<"]
    convs = {0: [("system", "be <kind>"), *[(("user", "assistant")[k % 2], "".join(rng.choice(bits) for _ in range(rng.randint(0, 900)))) for k in range(40)]]}
    convs[1] = [("user", None), ("assistant", "")]
    convs[2] = [("system", "only")]
    convs[3] = [("a|>b<", "x" * 9000), ("assistant", "y" * 9000), (None, "z")]
    rows = [(c, k, r, t) for c, turns in convs.items() for k, (r, t) in enumerate(turns)]
    df = chat.with_probe(spark.createDataFrame(rows, TURNS).withColumn("formatted", F.lit("clash")))
    formatted = chat.windows(df).cache()
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    convs[-1] = [("user", chat.PROBE), ("assistant", chat.PROBE)]
    for c, turns in convs.items():
        assert tuple(got[c])[1:5] == talk(turns), c
    windows = formatted.where("conv_id = 0").collect()
    assert len(windows) > 3 and all(w.formatted.count("be \\lkind>") == 1 for w in windows)
    for w in formatted.collect():
        assert "[INST]" not in w.formatted and "</s>" not in w.formatted


def test_chat_of_odd_tables(spark):
    assert chat.windows(spark.createDataFrame([], TURNS)).count() == 0
    rows = [(None, None, "user", "b"), (None, None, "user", "a"), (None, None, "user", "a")]
    got = chat.read_back(chat.windows(spark.createDataFrame(rows, TURNS))).collect()
    assert len(got) == 1 and got[0].n_turns == 3
    assert got[0].turns_sha256 == talk([("user", "a"), ("user", "a"), ("user", "b")])[1]


def conversations():
    rng = random.Random(12)
    said = lambda n: "".join(rng.choice(["word ", "日本", "<|end|>", "x"]) for _ in range(n))
    convs = {
        0: [("system", "s" * 3600), *[(("user", "assistant")[k % 2], "t" * 300) for k in range(20)]],  # a long system turn
        1: [("system", said(40)), *[(("user", "assistant")[k % 2], said(rng.randint(0, 120))) for k in range(60)]],
        2: [(("user", "assistant")[k % 2], "short") for k in range(200)],
        3: [("system", "s" * 5000), ("user", "a"), ("assistant", "b" * 9000), ("user", "c")],  # nothing fits beside it
        4: [("user", "x" * 4077), ("assistant", "y" * 2040), ("user", "z" * 2040), ("assistant", "ok")],
    }
    return convs, [(c, k, r, t) for c, turns in convs.items() for k, (r, t) in enumerate(turns)]


def plain_windows(turns, budget=4096, history=1024):
    """The windows of one conversation, step by step: (system turn, history, own turns)."""
    esc = lambda x: x.replace("\\", "\\z").replace("<", "\\l").replace("[", "\\b").replace("|", "\\p")
    size = lambda x: len(esc(x[0]).encode()) + len(esc(x[1]).encode()) + 15
    sys = turns[0] if turns and turns[0][0] == "system" else None
    rest = turns[1:] if sys else turns
    room = budget - (size(sys) if sys else 0)
    half = max(1, room // 2)
    out, key, small, bigs = [], None, 0, 0
    for k, x in enumerate(rest):
        big = size(x) > half
        bigs += big
        now = (bigs, -1 if big else small // half)
        small += 0 if big else size(x)
        if now != key:
            out.append([k, k])
        out[-1][1], key = k + 1, now
    found = []
    for n, (a, b) in enumerate(out):
        left = min(history, room - sum(map(size, rest[a:b])))
        h = a
        while n and h > 0 and sum(map(size, rest[h - 1 : a])) <= left:
            h -= 1
        found.append((sys, rest[h:a], rest[a:b]))
    write = lambda kind, x: f"<|{kind} {esc(x[0])}|>{esc(x[1])}<|end|>"
    return ["".join([write("rep" if n else "sys", s)] if s else []) + "".join(write("his", x) for x in h) + "".join(write("new", x) for x in own) for n, (s, h, own) in enumerate(found)]


def test_windows_are_within_the_budget(spark):
    convs, rows = conversations()
    got = defaultdict(list)
    for w in chat.windows(spark.createDataFrame(rows, TURNS)).orderBy("conv_id", "window").collect():
        got[w.conv_id].append(w.formatted)
    for c, turns in convs.items():
        assert got[c] == plain_windows(turns), c
        for w in got[c]:
            own = w.count("<|new ")
            alone = own == 1 and "<|his " not in w
            assert len(w.encode()) <= chat.BUDGET or alone, c
    assert all(len(w.encode()) <= chat.BUDGET for c in (0, 1, 2, 4) for w in got[c])
    assert any(w.count("<|his ") > 5 for w in got[2])
    back = {r.conv_id: r for r in chat.read_back(chat.windows(spark.createDataFrame(rows, TURNS))).collect()}
    for c, turns in convs.items():
        assert tuple(back[c])[1:5] == talk(turns), c
