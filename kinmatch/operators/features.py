"""Pair features: ids hydrated with normalised records, then native expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.similarity import FEATURES, field_features, sets_of

_OF = {"name_norm": "n", "address_norm": "a", "country_norm": "c"}


def _side(entities: DataFrame, id_: str, side: str) -> DataFrame:
    rows = entities.select(F.col("entity_id").alias(id_), *[F.col(c).alias(f"{side}{x}") for c, x in _OF.items()])
    return rows.withColumns(sets_of(f"{side}n", f"{side}a"))


def hydrated(pairs: DataFrame, s1: DataFrame, target: DataFrame) -> DataFrame:
    """The pairs with an, aa, ac and bn, ba, bc: name, address and country of either side."""
    a, b = _side(s1, "source1_entity_id", "a"), _side(target, "candidate_entity_id", "b")
    return pairs.join(a, "source1_entity_id").join(b, "candidate_entity_id")


def features(rows: DataFrame, combined: str = "token") -> DataFrame:
    """Features of hydrated rows. `combined` picks one of the two forms of combined_similarity:
    `token`, of both fields' tokens, or `char`, of the name's trigrams and tokens."""
    values = field_features("an", "bn", "name") | field_features("aa", "ba", "address")
    kept = [c for c in rows.columns if c in (*S.PAIR, "label")]
    made = rows.select(*kept, *[v.alias(k) for k, v in values.items()], F.coalesce((F.col("ac") != "") & (F.col("ac") == F.col("bc")), F.lit(False)).cast("int").alias("country_exact"))
    other = "address_token_jaccard" if combined == "token" else "name_char_jaccard"
    made = made.withColumn("combined_similarity", (F.col("name_token_jaccard") + F.col(other)) / 2)
    return made.select(*kept, *FEATURES)


def make_features(pairs: DataFrame, s1: DataFrame, target: DataFrame, combined: str = "token") -> DataFrame:
    return features(hydrated(pairs, s1, target), combined)


def aligned(df: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Exactly `columns`, after the others: what is missing, null, NaN or infinite becomes 0."""
    clean = lambda c: F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf")), F.lit(0.0)).otherwise(F.col(c).cast("double"))
    return df.select(*[c for c in df.columns if c not in FEATURES], *[(clean(c) if c in df.columns else F.lit(0.0)).alias(c) for c in columns])
