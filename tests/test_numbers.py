"""Every number that results depend on, as plain values, apart from code and SQL."""

import pytest

from kinmatch import schema as S
from kinmatch.operators import model, postings
from kinmatch.plans import sql

#: Rule: cap on the left, cap on the right, evidence.
RULES = """
B01 300 300 10
B02 80 80 9
B03 200 200 8
B04 80 80 7
B05 200 200 6
B06 100 100 5
B07 120 120 4
B08 250 250 4
B09 250 250 3
B10 200 200 2
B12 - 100 -
B13 - 100 -
B14 - 50 -
B15 - 80 -
B16 - 50 -
"""


def test_rules():
    want = [(r, *(None if x == "-" else int(x) for x in xs)) for r, *xs in map(str.split, RULES.strip().splitlines())]
    assert [(r.id, r.cap_left, r.cap_right, r.evidence) for r in S.RULES] == want
    assert {k: tuple(x or None for x in v) for k, v in sql.NUMBERS.items()} == {r: tuple(xs) for r, *xs in want}


def test_settings():
    s = S.DEFAULT
    assert (s.top, s.pair_tokens, s.threshold, s.train_negatives, s.valid_negatives, s.max_postings, s.max_per_entity) == (40, 5, 0.97, 15, 25, 250, 300)
    assert s.thresholds == (0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.92, 0.95)
    assert s.fine == pytest.approx([0.8 + 0.01 * k for k in range(20)])
    assert model.TREES == 350
    assert postings.WEIGHTS == {"exact_name": 8, "exact_addr": 7, "combo": 6, "name_prefix": 5, "name_tok": 4, "addr_tok": 3, "ngram": 2}


def test_lists():
    assert len(S.SECOND_WORD_STOPS) == 10 and len(S.NAME_TOKEN_STOPS) == 20 and len(S.ADDRESS_TOKEN_STOPS) == 38 and len(S.ADDRESS_PAIR_STOPS) == 32 and len(S.NAME_ABBREVIATIONS) == 4 and len(S.ADDRESS_ABBREVIATIONS) == 9
    for words in (S.NAME_TOKEN_STOPS, S.ADDRESS_TOKEN_STOPS, S.ADDRESS_PAIR_STOPS):
        assert words == sorted(set(words))


def test_scores_round_as_the_sql_does(spark, tmp_path):
    """Means of ratios of small numbers, some of them a hair off a half in the sixth decimal."""
    import duckdb
    from pyspark.sql import functions as F

    from kinmatch.functions.similarity import rounded

    path = str(tmp_path / "ratios.parquet")
    duckdb.sql(f"copy (select (a.i::double / a.n + b.i::double / b.n) / 2 as x from (select i, n from range(1, 81) t(n), range(0, 81) u(i) where i <= n and n in (16, 25, 32, 40, 50, 64, 80)) a, (select i, n from range(1, 81) t(n), range(0, 81) u(i) where i <= n and n in (25, 32, 50, 64, 78, 80)) b) to '{path}' (format parquet)")
    shown = lambda r: spark.read.parquet(path).select("x", F.format_string("%.8f", r(F.col("x"), 6)).alias("s")).distinct().collect()
    want = dict(duckdb.sql(f"select distinct x, printf('%.8f', round(x, 6)) from '{path}'").fetchall())
    assert {r["x"]: r["s"] for r in shown(rounded)} == want
    assert {r["x"]: r["s"] for r in shown(F.round)} != want
