"""A corpus pipeline over `documents`: language ID, quality rules, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but
the last return the columns of `documents`. run() writes each stage's rows and removes the table
before it once these are written.

Defined results: a document with a null text or one without a letter is rejected by the first
stage, one of under ten words by the second; very long texts go through whole; rows with equal
texts or near-equal fingerprints leave the one of the smallest id, rows with equal ids count as one
document, and rows without an id all stay (near_dup.keep_first); ties are broken as the modules of
the operators say; null sources are a source of their own in the mix; an empty table gives an empty
result; columns other than those of `documents` are dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.llm import language, mixing, near_dup, packing, quality_rules
from kinmatch.llm.common import discard, texts, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those between two languages (ambiguous codewords)."""
    model = language.train(language.training_rows(docs))
    found = language.identify(docs, model, COLUMNS)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & ~F.col("ambiguous")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that fail a rule of the current policy."""
    return quality_rules.ledger(docs, carry=COLUMNS).where(quality_rules.kept_by(quality_rules.CURRENT)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each component of near-duplicates."""
    return near_dup.keep_first(docs.select(*COLUMNS))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the systematic sample of its source takes it."""
    return mixing.sample(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixing_to_weights),
    ("packing", pack),
]

#: No SQL expresses the classifiers, fingerprints and tokenizer; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, written(stage(spark, docs, sf_dir), f"stage-{k}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
