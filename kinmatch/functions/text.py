"""Normal forms and tokens, as column expressions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import schema as S


def let(value: Column, body) -> Column:
    """`body` over `value`, computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def abbreviated(c: Column, words: dict[str, str]) -> Column:
    """Whole words of a normalised text replaced."""
    of = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    return F.array_join(F.transform(F.split(c, " "), lambda t: F.coalesce(F.element_at(of, t), t)), " ")


def ascii_base(c: Column) -> Column:
    kept = F.regexp_replace(F.coalesce(c, F.lit("")), "[^\\p{Alnum} ]", " ")
    return F.lower(F.trim(F.regexp_replace(kept, "\\s+", " ")))


def name_norm(c: Column) -> Column:
    return abbreviated(ascii_base(c), S.NAME_ABBREVIATIONS)


def address_norm(c: Column) -> Column:
    return abbreviated(ascii_base(c), S.ADDRESS_ABBREVIATIONS)


def country_norm(c: Column) -> Column:
    """Null stays null, so that rules within a country don't link it."""
    return F.lower(F.trim(c))


def _nfkc(c: Column) -> Column:
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.fillna("").str.normalize("NFKC")

    return F.pandas_udf(run, StringType())(c)


def unicode_base(c: Column) -> Column:
    """NFKC, lower case, other characters than word characters and space to space. Spark has no
    NFKC function, so that step is an Arrow UDF; it keeps accents and the underscore."""
    kept = F.regexp_replace(F.lower(_nfkc(F.coalesce(c, F.lit("")))), "(?U)[^\\w\\s]", " ")
    return F.trim(F.regexp_replace(kept, "(?U)\\s+", " "))


def normalised(df: DataFrame, mode: str = "ascii") -> DataFrame:
    """The columns of `df` and name_norm, address_norm and country_norm."""
    n, a, c = F.col("business_name"), F.col("business_address"), F.col("country")
    if mode == "ascii":
        return df.withColumns({"name_norm": name_norm(n), "address_norm": address_norm(a), "country_norm": country_norm(c)})
    based = df.withColumns({"name_norm": unicode_base(n), "address_norm": unicode_base(a), "country_norm": unicode_base(c)})
    return based.withColumns({"name_norm": abbreviated(F.col("name_norm"), S.NAME_ABBREVIATIONS), "address_norm": abbreviated(F.col("address_norm"), S.UNICODE_ADDRESS_ABBREVIATIONS)})


def first_word(c: Column, n: int) -> Column:
    return F.substring(F.split_part(c, F.lit(" "), F.lit(1)), 1, n)


def without_zeros(c: Column) -> Column:
    return F.ltrim(c, F.lit("0"))


def first_number(c: Column) -> Column:
    return without_zeros(F.regexp_extract(c, "([0-9]{1,6})", 1))


def numbers(c: Column, least: int, most: int) -> Column:
    """Distinct runs of digits, without leading zeros; the length is tested before these go."""
    found = F.regexp_extract_all(c, F.lit(f"[0-9]{{{least},{most}}}"), F.lit(0))
    return F.array_distinct(F.filter(F.transform(found, without_zeros), lambda x: x != ""))


def longest_first(tokens: Column) -> Column:
    """By length, the longest first, then by text; repeats stay."""
    keyed = F.array_sort(F.transform(tokens, lambda t: F.struct((-F.length(t)).alias("l"), t.alias("t"))))
    return F.transform(keyed, lambda x: x["t"])


def name_tokens(c: Column) -> Column:
    return longest_first(F.filter(F.split(c, " "), lambda t: (F.length(t) >= 5) & ~t.isin(*S.NAME_TOKEN_STOPS)))


def address_tokens(c: Column) -> Column:
    return longest_first(F.filter(F.split(c, " "), lambda t: (F.length(t) >= 5) & ~t.isin(*S.ADDRESS_TOKEN_STOPS)))


def address_words(c: Column, most: int | None) -> Column:
    """Distinct alphabetic tokens of 4 letters or more, at most the `most` longest."""
    found = longest_first(F.array_distinct(F.filter(F.split(c, " "), lambda t: (F.length(t) >= 4) & t.rlike("^[a-z]+$") & ~t.isin(*S.ADDRESS_PAIR_STOPS))))
    return found if most is None else F.slice(found, 1, most)


def token_pairs(words: Column) -> Column:
    """All ordered pairs of distinct words, within the row."""
    return F.flatten(F.transform(words, lambda a: F.transform(F.filter(words, lambda b: a < b), lambda b: F.struct(a.alias("a"), b.alias("b")))))


def token_set(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[a-z0-9]+"), F.lit(0)))


def trigrams(c: Column) -> Column:
    padded = F.concat(F.lit("  "), c, F.lit("  "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) + 2), lambda i: F.substring(padded, i, F.lit(3))))
