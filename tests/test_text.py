"""Normal forms, tokens and similarities on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from kinmatch.functions import similarity as M
from kinmatch.functions import text as X


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("f", "value", "expected"),
    [
        (X.name_norm, "Acme  Private-Limited!", "acme pvt ltd"),
        (X.name_norm, "Café", "caf"),
        (X.name_norm, None, ""),
        (X.unicode_base, "Café", "café"),
        (X.unicode_base, "ﬁne_Print № 5", "fine_print no 5"),
        (X.address_norm, "12 Main Street, Suite 4", "12 main st ste 4"),
        (X.address_norm, "1 Roadway", "1 roadway"),
        (X.first_number, "007 main", "7"),
        (X.first_number, "main", ""),
        (X.country_norm, " US ", "us"),
        (X.country_norm, None, None),
        (lambda c: F.array_join(X.numbers(c, 3, 8), ","), "007 main 12", "7"),
        (lambda c: F.array_join(X.numbers(c, 1, 6), ","), "1234567", "123456,7"),
        (lambda c: F.get(X.name_tokens(c), F.lit(1)), "global global tools", "global"),
        (lambda c: F.array_join(X.address_tokens(c), ","), "near longest mumbai shorter", "longest,shorter"),
        (lambda c: F.size(X.trigrams(c)), "", 1),
        (lambda c: F.size(X.let(X.address_words(c, 5), X.token_pairs)), "aaaa bbbb cccc dddd eeee ffff", 10),
    ],
)
def test_text(spark, f, value, expected):
    assert one(spark, value, f) == expected


def pair(spark, a, b):
    rows = spark.createDataFrame([(a, b)], "an string, bn string").withColumns(M.sets_of("an", "bn"))
    return rows.select(*[v.alias(k) for k, v in M.field_features("an", "bn", "f").items()]).first().asDict()


def test_both_empty(spark):
    x = pair(spark, "", "")
    assert (x["f_char_jaccard"], x["f_token_jaccard"], x["f_edit"], x["f_exact"]) == (1.0, 0.0, 1.0, 0)
    assert (x["f_missing_a"], x["f_missing_b"], x["f_tfidf_cosine"]) == (1, 1, 0.0)


def test_one_empty(spark):
    x = pair(spark, "", "abc")
    assert (x["f_char_jaccard"], x["f_edit"], x["f_length_delta"]) == (0.0, 0.0, 1.0)


def test_cosine(spark):
    assert pair(spark, "a b", "a c")["f_tfidf_cosine"] == pytest.approx(1 / (1 + (1 + math.log(1.5)) ** 2))


def test_bounds(spark):
    for a, b in (("acme pvt ltd", "acme ltd"), ("x1 y2", "y2 z3"), ("same", "same")):
        x = pair(spark, a, b)
        assert all(0 <= v <= 1 for v in x.values()), x
    assert pair(spark, "x1 y2", "y2 z3")["f_number_overlap"] == pytest.approx(1 / 3)
