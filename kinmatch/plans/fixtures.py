"""The test tables as linkage entities: `documents` holds copies, so it has true pairs.

Records of the linkage are short fields, which documents lack, so the fixture projects each
document to one: its first line (up to 40 characters) is the name, its length and the next 40
characters are the address. Truth is of whole texts. All rows take part."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as X
from ..functions.similarity import rounded
from ..operators import blocking, features, labeling
from ..workspace import spread


class Frames:
    """Frames over one folder of tables, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: S.Settings = S.DEFAULT):
        self.spark, self.dir, self.settings = spark, sf_dir, settings

    @cached_property
    def entities(self) -> DataFrame:
        docs = self.spark.read.parquet(f"{self.dir}/documents.parquet")
        rows = docs.select(
            F.concat(F.lit("S"), 1 + F.col("doc_id") % 3, F.lit("-"), F.col("doc_id")).alias("entity_id"),
            F.when(F.col("doc_id") % 20 == 7, F.lit("")).otherwise(F.regexp_extract("text", "^[^\n]{0,40}", 0)).alias("business_name"),
            F.concat(F.col("n_chars").cast("string"), F.lit(" "), F.substring("text", 41, 40)).alias("business_address"),
            F.when(F.col("doc_id") % 50 == 11, F.lit(None)).otherwise(F.col("lang")).alias("country"),
            (F.col("doc_id") % 3).alias("src"),
            "doc_id",
            F.md5("text").alias("digest"),
        )
        return spread(rows, docs)

    def source(self, *src: int) -> DataFrame:
        return self.entities.where(F.col("src").isin(*src)).select("entity_id", "business_name", "business_address", "country", "src", "doc_id")

    @cached_property
    def s1(self) -> DataFrame:
        return X.normalised(self.source(0))

    @cached_property
    def s2(self) -> DataFrame:
        return X.normalised(self.source(1))

    @cached_property
    def s3(self) -> DataFrame:
        return X.normalised(self.source(2))

    @cached_property
    def target(self) -> DataFrame:
        return self.s2.unionByName(self.s3)

    @cached_property
    def truth(self) -> DataFrame:
        """Entities of equal whole texts. Source 1 has no duplicates, so of several with a text the
        smallest stands for it, and a text that a third of the rows has gives a pair a row."""
        a = self.entities.where("src = 0 and digest is not null").groupBy("digest").agg(F.min("entity_id").alias("source1_entity_id"))
        b = self.entities.where("src <> 0").select("digest", F.col("entity_id").alias("candidate_entity_id"))
        return b.join(a, "digest").select(*S.PAIR)

    @cached_property
    def keys(self) -> tuple[DataFrame, DataFrame]:
        return blocking.key_tables(self.s1, self.target, self.settings)

    @cached_property
    def pairs(self) -> DataFrame:
        return blocking.rule_pairs(*self.keys)

    @cached_property
    def candidates(self) -> DataFrame:
        return blocking.chosen(*self.keys, self.settings.top)

    @cached_property
    def labelled(self) -> DataFrame:
        return labeling.labelled(self.candidates, self.truth)

    @cached_property
    def features(self) -> DataFrame:
        return features.make_features(self.labelled, self.s1, self.target)

    @cached_property
    def scored(self) -> DataFrame:
        """A score that any engine gives alike, for the queries on thresholds."""
        score = rounded((F.col("name_char_jaccard") + F.col("address_char_jaccard")) / 2, 6)
        return self.features.select(*S.PAIR, "label", score.alias("score"))
