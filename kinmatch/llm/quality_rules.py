"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per
failed rule; a policy is a named mask over those bits, so a new version of a policy, or an
ablation of one of its rules, reads only the ledger and never a text.

Defined results: a null or empty text has no words and fails the rule `few_words`; a very long text
is measured whole, within one row; equal texts have equal ledger rows; repeated rows are kept; an empty table gives an empty ledger; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_SPACE, let, texts, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rules in the order of their bits; a condition is true where the rule fails.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols_per_word", "100 * n_symbols > 20 * n_words"),
    ("repeated_lines", "n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "10 * word_chars < 20 * n_words"),
    ("long_words", "10 * word_chars > 200 * n_words"),
    ("shouting", "n_upper > 200 and 100 * n_upper > 50 * word_chars"),
]
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}

#: Versions of the policy: the rules whose failure rejects a document.
POLICIES: dict[str, list[str]] = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "symbols_per_word", "repeated_lines"],
    "v2": [name for name, _ in RULES],
}
CURRENT = "v2"


def mask(policy: str | list[str]) -> int:
    return sum(BIT[r] for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def _repeat_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur at least twice in the text.

    Windows are compared by a 64-bit hash. Only texts in which a hash repeats take the
    second step: sort (hash, position), keep positions with an equal neighbour, and add up
    the union of the windows that start there. O(n log n) in the words of one text."""

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        last = F.size(h) - 1

        def starts(s: Column) -> Column:
            again = F.filter(s, lambda e, j: ((j > 0) & (F.get(s, j - 1)["h"] == e["h"])) | ((j < last) & (F.get(s, j + 1)["h"] == e["h"])))
            return F.sort_array(F.transform(again, lambda e: e["i"]))

        def union(p: Column) -> Column:
            steps = F.transform(p, lambda x, k: F.when(k < F.size(p) - 1, F.least(F.lit(WINDOW), F.get(p, k + 1) - x)).otherwise(F.lit(WINDOW)))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(let(pairs, starts), union)

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    twice = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(let(hashes, twice))


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of `docs`: the id, or the columns in `carry`, and all measurements (long)."""
    names = carry or (id_col,)
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(WORD_SPACE)) != "")
    without = lambda chars: F.length(F.translate(text, chars, ""))
    measured = let(
        words_of(F.col(text_col)),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words")),
    )
    line_counts = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return docs.select(
        *names,
        measured.alias("_words"),
        line_counts.alias("_lines"),
        without(WORD_SPACE).cast("long").alias("word_chars"),
        (F.length(text) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length(text) - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_upper"),
    ).select(*names, "_words.n_words", "word_chars", "n_symbols", "_lines.n_dup_lines", "_words.n_repeat_words", "_lines.n_lines", "n_upper")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """The measurements and `failure_bits`, one bit for each of RULES."""
    bits = None
    for name, failed in RULES:
        bit = F.when(F.expr(failed), F.lit(BIT[name])).otherwise(F.lit(0))
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return measurements(docs, id_col, text_col, carry).withColumn("failure_bits", bits.cast("long"))


def kept_by(policy: str | list[str]) -> Column:
    """Over a ledger: whether no rule of the policy failed."""
    return F.col("failure_bits").bitwiseAND(F.lit(mask(policy))) == 0


def ablations(rows: DataFrame, policy: str | list[str] = CURRENT) -> DataFrame:
    """For each rule of the policy over a ledger: documents that fail it, that only it rejects,
    that the policy without it keeps, and which bits its failures have in any and in all."""
    names = POLICIES[policy] if isinstance(policy, str) else list(policy)
    whole = mask(names)
    bits = F.col("failure_bits")
    aggs = [F.count(F.lit(1)).alias("n_docs"), F.count_if(bits.bitwiseAND(F.lit(whole)) == 0).alias("n_kept")]
    for r in names:
        failed = bits.bitwiseAND(F.lit(BIT[r])) != 0
        aggs += [
            F.count_if(failed).alias(f"{r}_failed"),
            F.count_if(bits.bitwiseAND(F.lit(whole)) == BIT[r]).alias(f"{r}_alone"),
            F.count_if(bits.bitwiseAND(F.lit(whole & ~BIT[r])) == 0).alias(f"{r}_kept_without"),
            F.coalesce(F.bit_or(F.when(failed, bits)), F.lit(0)).alias(f"{r}_any"),
            F.coalesce(F.bit_and(F.when(failed, bits)), F.lit(0)).alias(f"{r}_all"),
        ]
    parts = [
        F.struct(F.lit(r).alias("rule"), *[F.col(f"{r}_{x}").alias(y) for x, y in (("failed", "n_failed"), ("alone", "n_only_this"), ("kept_without", "n_kept_without"), ("any", "bits_in_any"), ("all", "bits_in_all"))])
        for r in names
    ]
    return rows.agg(*aggs).select("n_docs", "n_kept", F.explode(F.array(*parts)).alias("x")).select("n_docs", "n_kept", "x.*")


def op2_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(texts(spark, sf_dir))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~kept_by("base")).alias("base_failed"), kept_by(CURRENT).alias("kept"), "failure_bits",
    )


_CONDITIONS = ["n_words < 10", "100 * n_repeat_words > 20 * n_words", "100 * n_symbols > 20 * n_words", "n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines", "10 * word_chars < 20 * n_words", "10 * word_chars > 200 * n_words", "n_upper > 200 and 100 * n_upper > 50 * word_chars"]

OP2_SQL = f"""
with w as (
  select doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents),
g as (
  select *, row_number() over () as rid,
         case when len(words) < 5 then []::varchar[] else
         list_transform(range(1, len(words) - 3), lambda i: concat_ws(' ', words[i], words[i+1], words[i+2], words[i+3], words[i+4])) end as wins
  from w),
r as (
  select rid, s, lead(s) over (partition by rid order by s) as nxt
  from (select rid, s, count(*) over (partition by rid, win) as c
        from (select rid, unnest(wins) as win, generate_subscripts(wins, 1) as s from g)) where c >= 2),
rep as (select rid, sum(least(5, coalesce(nxt - s, 5)))::bigint as n from r group by rid),
m as (
  select doc_id, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(rep.n, 0)::bigint as n_repeat_words, len(lines)::bigint as n_lines,
         (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))::bigint as n_upper
  from g left join rep using (rid)),
b as (select *, ({' + '.join(f'case when {c} then {1 << k} else 0 end' for k, c in enumerate(_CONDITIONS))})::bigint as failure_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failure_bits & 3) <> 0 as base_failed, failure_bits = 0 as kept, failure_bits
from b
"""
