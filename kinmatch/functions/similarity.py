"""Similarities of two normalised strings, as column expressions without Python."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import token_set, trigrams

def rounded(x: Column, digits: int) -> Column:
    """`x` to `digits` decimals in binary arithmetic, as SQL engines in C round: Spark's `round`
    takes the shortest decimal form of a double instead, so close to a half it may go the other
    way. Without digits both agree, as a half is a double itself."""
    by = F.lit(10.0**digits)
    return F.round(x * by, 0) / by


_FIELDS = ("exact", "char_jaccard", "token_jaccard", "token_containment", "tfidf_cosine", "number_overlap", "edit", "length_delta", "missing_a", "missing_b")
#: Square of 1 + ln 1.5, the weight of a term that only one of two records has.
ALONE = (1 + math.log(1.5)) ** 2


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / F.greatest(F.lit(1), F.size(a) + F.size(b) - both)


def containment(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), F.least(F.size(a), F.size(b)))


def tfidf_cosine(a: Column, b: Column) -> Column:
    """Cosine where the two records are the corpus: a shared term weighs 1, another ALONE."""
    both = F.size(F.array_intersect(a, b))
    norm = lambda x: F.sqrt(both + F.lit(ALONE) * (F.size(x) - both))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (norm(a) * norm(b)))


def with_digit(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t.rlike("[0-9]"))


def edit(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(1 - F.levenshtein(a, b) / longest)


def field_features(a: str, b: str, prefix: str) -> dict[str, Column]:
    """Ten features of a field; `a` and `b` are columns, whose token and trigram sets are
    expected beside them as `<column>_tok` and `<column>_tri`."""
    x, y = F.col(a), F.col(b)
    s, t = F.col(f"{a}_tok"), F.col(f"{b}_tok")
    longest = F.greatest(F.length(x), F.length(y))
    values = (
        ((x != "") & (x == y)).cast("int"),
        jaccard(F.col(f"{a}_tri"), F.col(f"{b}_tri")),
        jaccard(s, t),
        containment(s, t),
        tfidf_cosine(s, t),
        jaccard(with_digit(s), with_digit(t)),
        edit(x, y),
        F.abs(F.length(x) - F.length(y)) / F.greatest(F.lit(1), longest),
        (x == "").cast("int"),
        (y == "").cast("int"),
    )
    return {f"{prefix}_{name}": v for name, v in zip(_FIELDS, values)}


def sets_of(*columns: str) -> dict[str, Column]:
    """The sets that field_features reads, once per record instead of once per pair."""
    return {f"{c}_{k}": f(F.col(c)) for c in columns for k, f in (("tok", token_set), ("tri", trigrams))}


FEATURES = [f"{p}_{f}" for p in ("name", "address") for f in _FIELDS] + ["country_exact", "combined_similarity"]
