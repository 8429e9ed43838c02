"""Chat formatting in budgeted windows.

Prefix sums of turn tokens cut each conversation into turn-aligned spans. Every window holds the
system turn, a limited history repeated from before the span, and the span's own turns; only the
texts of assistant turns of the span are under the loss mask, so each is a target exactly once.

A turn is written as `<|KIND ROLE|>TEXT<|end|>` with KIND `sys` (the system turn, in the first
window), `rep` (the system turn, repeated), `his` (history, repeated) or `new`. In roles and
texts every `\\`, `<`, `[` and `|` is written as a backslash and a letter, so no control string
of this or of a bracket template (`</s>`, `[INST]`) comes from a text, and reading is exact.

A turn's tokens are bounded by the UTF-8 bytes of what is written for it, header and end mark
included: no byte-level tokenizer makes more tokens than bytes, whatever the script. The system
turn counts against the budget first; what it leaves is the room. Prefix sums of the other turns
are cut at multiples of half the room, and a turn longer than that has a window of its own, so the
turns of a window fit into the room. History is the longest run of turns right before the window
that fits into HISTORY and into what the window leaves of the room. A window is therefore within
the budget unless its system turn and one single turn alone are longer; then it holds these two,
whole, and no history.

Defined results: null texts and roles are empty; very long turns stay whole; rows are ordered by
turn (null first), then by role and text, so repeated rows are turns of their own; the first row
is the system turn if its role is `system`, later ones are ordinary turns; null conv_id is one
conversation; turns of a conversation -1 join the probe's; an empty table gives an empty result;
other columns are ignored, whatever their names. A conversation is one training example, so its
rows meet in one task; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, table

#: Most tokens of a window, and of the history in it.
BUDGET = 4096
HISTORY = 1024
END = "<|end|>"
#: Characters of control strings and the letters that stand for them after a backslash.
ESCAPES = [("\\", "z"), ("<", "l"), ("[", "b"), ("|", "p")]
PROBE = "</s>[INST] ok [/INST]"


def escape(c: Column) -> Column:
    for char, letter in ESCAPES:
        c = F.replace(c, F.lit(char), F.lit("\\" + letter))
    return c


def unescape(c: Column) -> Column:
    for char, letter in reversed(ESCAPES):
        c = F.replace(c, F.lit("\\" + letter), F.lit(char))
    return c


def _header(kind: str, role: Column) -> Column:
    return F.concat(F.lit(f"<|{kind} "), role, F.lit("|>"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, formatted and loss_spans: arrays of (start, length) in code points."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("*", escape(F.col("role")).alias("r"), escape(F.col("text")).alias("t"))
    rows = rows.withColumn("tokens", (F.octet_length("r") + F.octet_length("t") + len("<|new |>") + len(END)).cast("long"))
    conv = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("pos", F.row_number().over(conv)).withColumn("system", (F.col("pos") == 1) & (F.col("role") == "system"))
    so_far = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("sys", F.first(F.when(F.col("system"), F.struct("r", "t", "tokens"))).over(so_far))
    rows = rows.withColumn("room", F.lit(budget) - F.coalesce(F.col("sys.tokens"), F.lit(0)))
    stride = F.greatest(F.lit(1), F.floor(F.col("room") / 2))
    own = F.when(F.col("system"), F.lit(0)).otherwise(F.col("tokens"))
    big = ~F.col("system") & (F.col("tokens") > stride)
    small = F.when(big, F.lit(0)).otherwise(own)
    rows = rows.withColumns({"before": F.sum(own).over(so_far) - own, "bigs": F.sum(big.cast("long")).over(so_far), "cell": F.when(big, F.lit(-1)).otherwise(F.floor((F.sum(small).over(so_far) - small) / stride))})
    # a window ends where the key (bigs, cell) changes; the system turn opens the first
    in_order = Window.partitionBy("conv_id").orderBy("pos")
    last = lambda c: F.lag(c, 1).over(in_order)
    new = (F.col("pos") > 1) & ~F.coalesce(last("system"), F.lit(False)) & ((F.col("bigs") != last("bigs")) | (F.col("cell") != last("cell")))
    rows = rows.withColumn("first", new)
    rows = rows.withColumn("window", F.sum(F.col("first").cast("long")).over(so_far))
    content = F.sum(own).over(Window.partitionBy("conv_id", "window"))
    allowed = F.least(F.lit(history), F.col("room") - content)
    # prefix sums grow with each turn but the system's, so a range of them is a run of turns
    run = Window.partitionBy("conv_id").orderBy("before").rangeBetween(-history, -1)
    past = F.when(~F.col("system"), F.struct("before", "r", "t"))
    rows = rows.withColumn("past", F.collect_list(past).over(run)).withColumn("allowed", allowed)
    said = lambda kind, x: F.concat(_header(kind, x["r"]), x["t"], F.lit(END))
    kept = F.array_sort(F.filter("past", lambda x: F.col("before") - x["before"] <= F.col("allowed")))
    prefix = F.when(
        F.col("first"),
        F.concat(F.when(F.col("sys").isNotNull(), said("rep", F.col("sys"))).otherwise(F.lit("")), F.array_join(F.transform(kept, lambda x: said("his", x)), "")),
    ).otherwise(F.lit(""))
    header = F.when(F.col("system"), _header("sys", F.col("r"))).otherwise(_header("new", F.col("r")))
    rows = rows.select("conv_id", "window", "pos", "role", "t", "system", prefix.alias("prefix"), header.alias("header"))
    size = F.length("prefix") + F.length("header") + F.length("t") + len(END)
    within = Window.partitionBy("conv_id", "window").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.sum(size).over(within) - len(END) - F.length("t")
    target = (F.col("role") == "assistant") & ~F.col("system")
    rows = rows.select(
        "conv_id", "window", "pos", F.concat("prefix", "header", "t", F.lit(END)).alias("piece"),
        F.when(target, F.struct(start.alias("start"), F.length("t").cast("long").alias("length"))).alias("span"),
    )
    grouped = rows.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(F.struct("pos", "piece", "span"))).alias("x"))
    spans = F.transform(F.filter("x", lambda e: e["span"].isNotNull()), lambda e: e["span"])
    return grouped.select("conv_id", "window", F.array_join(F.transform("x", lambda e: e["piece"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its windows hold, read from `formatted` and `loss_spans` alone."""

    def own_turns(text: Column) -> Column:
        parts = F.filter(F.split(text, "<\\|end\\|>"), lambda p: p.startswith("<|new ") | p.startswith("<|sys "))
        return F.transform(
            parts,
            lambda p: F.concat(
                unescape(F.substr(F.substring_index(p, "|>", 1), F.lit(7))),
                F.lit("\n"),
                unescape(F.substr(p, F.length(F.substring_index(p, "|>", 1)) + 3)),
                F.lit("\n"),
            ),
        )

    targets = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    per_window = formatted.select(
        "conv_id",
        "window",
        F.length("formatted").cast("long").alias("chars"),
        let(own_turns(F.col("formatted")), lambda x: F.struct(F.size(x).cast("long").alias("n"), F.array_join(x, "").alias("said"))).alias("turns"),
        F.array_join(targets, "").alias("loss"),
    )
    whole = per_window.groupBy("conv_id").agg(
        F.sum("turns.n").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("window", F.col("turns.said").alias("said"), "loss"))).alias("x"),
        F.sum("chars").alias("formatted_chars"),
    )
    joined = lambda field: F.array_join(F.transform("x", lambda e: e[field]), "")
    whole = whole.select("conv_id", "n_turns", joined("said").alias("said"), joined("loss").alias("loss"), "formatted_chars")
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return whole.select("conv_id", "n_turns", digest("said").alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), digest("loss").alias("loss_sha256"), "formatted_chars")


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns and conversation -1, whose texts look like control strings."""
    kinds = dict(turns.dtypes)
    probe = turns.sparkSession.range(1).select(F.explode(F.array(*[F.struct(F.lit(k).alias("turn"), F.lit(r).alias("role")) for k, r in enumerate(("user", "assistant"))])).alias("x"))
    probe = probe.select(F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"), F.col("x.turn").cast(kinds["turn"]).alias("turn"), "x.role", F.lit(PROBE).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").union(probe)


def op10_budgeted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(windows(with_probe(table(spark, sf_dir, "conversations"))))


def _sql_escaped(x: str) -> str:
    for char, letter in ESCAPES:
        x = f"replace({x}, '{char}', '\\{letter}')"
    return x


OP10_SQL = f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{PROBE}' union all select -1, 1, 'assistant', '{PROBE}'),
e as (select *, {_sql_escaped('role')} as r, {_sql_escaped('text')} as t from c),
p as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
         strlen(r) + strlen(t) + 15 as tokens, length(r) + length(t) + 15 as size from e),
s as (select *, pos = 1 and role = 'system' as sys from p),
m as (
  select *, max(case when sys then size end) over (partition by conv_id) as sys_size,
         4096 - coalesce(max(case when sys then tokens end) over (partition by conv_id), 0) as room, case when sys then 0 else tokens end as own from s),
h as (select *, greatest(1, floor(room / 2.0))::bigint as half, not sys and tokens > greatest(1, floor(room / 2.0))::bigint as big from m),
b as (
  select *, sum(own) over w - own as before, count(*) filter (big) over w as bigs,
         case when big then -1 else (sum(case when big then 0 else own end) over w - own) // half end as cell
  from h window w as (partition by conv_id order by pos)),
n as (
  select *, pos > 1 and not coalesce(lag(sys) over o, false) and (bigs <> lag(bigs) over o or cell <> lag(cell) over o) as first
  from b window o as (partition by conv_id order by pos)),
w as (select *, count(*) filter (first) over (partition by conv_id order by pos) as win from n),
a as (select *, least(1024, room - sum(own) over (partition by conv_id, win)) as allowed from w),
past as (
  select a.conv_id, a.pos, sum(b.size) as chars from a join a b on a.conv_id is not distinct from b.conv_id and not b.sys and b.before < a.before and a.before - b.before <= a.allowed
  where a.first group by 1, 2),
f as (
  select a.*, a.size + case when first then coalesce(sys_size, 0) + coalesce(past.chars, 0) else 0 end as chars
  from a left join past on a.conv_id is not distinct from past.conv_id and a.pos = past.pos)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by pos) filter (role = 'assistant'), '')) as loss_sha256,
       sum(chars)::bigint as formatted_chars
from f group by conv_id
"""
