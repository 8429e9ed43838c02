"""Queries on joins, blocking rules, the second blocker and diagnostics."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as X
from ..operators import blocking, diagnostics, features, labeling, postings
from ..workspace import folder
from .registry import query
from .sql import ADDRESS_PAIR_STOPS_SQL, HYDRATED, all_rules, over, q, rule_ctes

PAIRS = "source1_entity_id, candidate_entity_id"


def _only(f, *rules, **settings):
    s = replace(S.DEFAULT, rules=tuple(rules), **settings)
    return blocking.rule_pairs(*blocking.key_tables(f.s1, f.target, s)).select(*S.PAIR)


# --- joins -------------------------------------------------------------------------------

query("j01_equi_join", q(f"select a.entity_id as source1_entity_id, b.entity_id as candidate_entity_id from s1 a join target b using (country_norm, name_norm)"))(
    lambda f: f.s1.select("country_norm", "name_norm", F.col("entity_id").alias("source1_entity_id")).join(f.target.select("country_norm", "name_norm", F.col("entity_id").alias("candidate_entity_id")), ["country_norm", "name_norm"]).select(*S.PAIR)
)
query("j02_computed_key_join", q("select count(*) as n from s1 a join target b on substr(split_part(a.name_norm, ' ', 1), 1, 4) = substr(split_part(b.name_norm, ' ', 1), 1, 4) and a.country_norm = b.country_norm"))(
    lambda f: f.s1.select("country_norm", X.first_word(F.col("name_norm"), 4).alias("p")).join(f.target.select("country_norm", X.first_word(F.col("name_norm"), 4).alias("p")), ["country_norm", "p"]).agg(F.count(F.lit(1)).alias("n"))
)
query(
    "j03_frequency_join",
    q("select entity_id, l.n as left_n, r.n as right_n from s1 join (select name_norm, count(*) as n from s1 where name_norm <> '' group by 1) l using (name_norm) join (select name_norm, count(*) as n from target where name_norm <> '' group by 1) r using (name_norm) where l.n <= 80 and r.n <= 80"),
)(
    lambda f: f.s1.join(f.s1.where("name_norm <> ''").groupBy("name_norm").agg(F.count(F.lit(1)).alias("left_n")), "name_norm")
    .join(f.target.where("name_norm <> ''").groupBy("name_norm").agg(F.count(F.lit(1)).alias("right_n")), "name_norm")
    .where("left_n <= 80 and right_n <= 80")
    .select("entity_id", "left_n", "right_n")
)
query("j04_row_local_staging", q("select entity_id, k as key from b12_r where k is not null", rule_ctes("B12")))(
    lambda f: blocking.keyed(f.target, replace(S.DEFAULT, rules=("B12",))).select("entity_id", "key")
)
query(
    "j05_ordered_token_pairs",
    q(
        "select a.entity_id, a.token as tok1, b.token as tok2 from t a join t b on a.entity_id = b.entity_id and a.token < b.token",
        f"t as (select distinct entity_id, token from (select entity_id, unnest(string_split(address_norm, ' ')) as token from target) where length(token) >= 4 and regexp_full_match(token, '[a-z]+') and token not in {ADDRESS_PAIR_STOPS_SQL})",
    ),
)(lambda f: f.target.select("entity_id", F.explode(X.let(X.address_words(F.col("address_norm"), None), X.token_pairs)).alias("p")).select("entity_id", F.col("p.a").alias("tok1"), F.col("p.b").alias("tok2")))
query("j07_hydration", over("labelled", f"select {PAIRS}, an, aa, ac, bn, ba, bc from hyd", HYDRATED))(
    lambda f: features.hydrated(f.candidates, f.s1, f.target).select(*S.PAIR, "an", "aa", "ac", "bn", "ba", "bc")
)
query("j08_batch_restriction", over("candidates", f"select {PAIRS} from candidates where source1_entity_id in (select entity_id from s1 order by entity_id limit 50)"))(
    lambda f: f.candidates.join(f.s1.orderBy("entity_id").limit(50).select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi").select(*S.PAIR)
)
query("j09_labelling", over("labelled", f"select {PAIRS}, label from labelled"))(lambda f: f.labelled.select(*S.PAIR, "label"))
query("j10_keep_empty_groups", over("candidates", "select entity_id, count(c.candidate_entity_id) as n from s1 left join candidates c on source1_entity_id = entity_id group by 1"))(
    lambda f: f.s1.select(F.col("entity_id")).join(f.candidates, F.col("entity_id") == F.col("source1_entity_id"), "left").groupBy("entity_id").agg(F.count("candidate_entity_id").alias("n"))
)
query("j11_singletons", q("select entity_id from s1 where not exists (select 1 from truth where source1_entity_id = entity_id)"))(
    lambda f: f.s1.join(f.truth, F.col("entity_id") == F.col("source1_entity_id"), "left_anti").select("entity_id")
)
query("j12_truth_of_sample", q(f"select {PAIRS} from truth join (select entity_id from s1 order by md5(entity_id), entity_id limit 100) on entity_id = source1_entity_id"))(
    lambda f: f.truth.join(labeling.sample(f.s1, 100).select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id").select(*S.PAIR)
)
query("j13_left_join_rule_hits", q(f"select {PAIRS}, h.e is not null as hit from truth left join (select distinct *, 1 as e from b15_pairs) h using (source1_entity_id, candidate_entity_id)", rule_ctes("B15")))(
    lambda f: f.truth.join(_only(f, "B15").distinct().withColumn("e", F.lit(1)), list(S.PAIR), "left").select(*S.PAIR, F.col("e").isNotNull().alias("hit"))
)
query("j14_membership_probe", over("candidates", f"select {PAIRS}, exists (select 1 from truth t where t.source1_entity_id = c.source1_entity_id and t.candidate_entity_id = c.candidate_entity_id) as known from candidates c"))(
    lambda f: f.labelled.select(*S.PAIR, (F.col("label") == 1).alias("known"))
)
query("j16_point_probe", q(f"select {PAIRS} from truth where (source1_entity_id, candidate_entity_id) in (select (source1_entity_id, candidate_entity_id) from b16_pairs)", rule_ctes("B16", None)))(
    lambda f: f.truth.join(_only(f, "B16", pair_tokens=None), list(S.PAIR), "left_semi").select(*S.PAIR)
)
query("j06_nameless_lookup", q("select entity_id, k as key, name_norm = '' as nameless from b14_r where k is not null", rule_ctes("B14")))(lambda f: blocking.keyed(f.target, replace(S.DEFAULT, rules=("B14",))).select("entity_id", "key", "nameless"))
query("j15_keyed_lookup", q(f"select {PAIRS}, a.name_norm as an, b.name_norm as bn from truth join s1 a on a.entity_id = source1_entity_id join target b on b.entity_id = candidate_entity_id"))(
    lambda f: features.hydrated(f.truth, f.s1, f.target).select(*S.PAIR, "an", "bn")
)

# --- blocking rules --------------------------------------------------------------------------

_NAMES = {
    "B01": "b01_exact_name_country", "B02": "b02_exact_name", "B03": "b03_exact_address_country", "B04": "b04_exact_address", "B05": "b05_prefix_combo_country",
    "B06": "b06_prefix_combo", "B07": "b07_name_prefix_country", "B08": "b08_first_name_run", "B09": "b09_second_word", "B10": "b10_first_address_run",
    "B12": "b12_second_token_number", "B13": "b13_folded_prefix_number", "B14": "b14_nameless_number_token", "B15": "b15_address_number", "B16": "b16_address_token_pairs",
}
for _rule in S.RULES:  # B16 whole: every pair of an address's tokens; B19 is its bounded form
    query(_NAMES[_rule.id], q(f"select {PAIRS} from {_rule.id.lower()}_pairs", rule_ctes(_rule.id, None)))(lambda f, r=_rule.id: _only(f, r, pair_tokens=None))

query("a05_evidence", over("candidates", f"select {PAIRS}, evidence from evidence"))(lambda f: blocking.evidence(f.pairs))
query("a04_target_frequencies", q("select k as key, count(*) as n from b15_r where k is not null group by 1", rule_ctes("B15")))(
    lambda f: blocking.frequencies(blocking.keyed(f.target, replace(S.DEFAULT, rules=("B15",)))).select("key", "n")
)
query("w04_frequency_cap", q("select k as key, count(*) as n from b07_r where k is not null and c group by 1 having count(*) <= 120", rule_ctes("B07")))(
    lambda f: blocking.frequencies(blocking.keyed(f.target, replace(S.DEFAULT, rules=("B07",)))).where("n between 1 and 120").select("key", "n")
)
query("n01_top_40", over("candidates", f"select {PAIRS}, evidence, rn from ranked where rn <= 40"))(lambda f: blocking.best(blocking.evidence(f.pairs), 40))
query("b11_top_40", over("candidates", f"select {PAIRS} from ranked where rn <= 40"))(lambda f: blocking.best(blocking.evidence(f.pairs), f.settings.top).select(*S.PAIR))
query("w07_rank_filter", over("candidates", f"select {PAIRS} from ranked where rn = 2"))(lambda f: blocking.best(blocking.evidence(f.pairs), 2).where("rn = 2").select(*S.PAIR))
query("u02_union_of_rules", over("candidates", "select rule, count(*) as n from (" + " union all ".join(f"select '{r.id}' as rule from {r.id.lower()}_pairs" for r in S.RULES) + ") group by 1"))(lambda f: f.pairs.groupBy("rule").agg(F.count(F.lit(1)).alias("n")))
query("b17_candidates", over("candidates", f"select {PAIRS} from candidates"))(lambda f: f.candidates)
_13 = tuple(r.id for r in S.RULES if r.id not in ("B15", "B16"))
query("b18_thirteen_rules", q(f"select {PAIRS} from candidates", all_rules(_13)))(lambda f: blocking.candidates(f.s1, f.target, replace(S.DEFAULT, rules=_13)))
_RULES = tuple(r.id for r in S.RULES)
query("b17_unbounded_candidates", q(f"select {PAIRS} from candidates", all_rules(_RULES, most=None)))(lambda f: blocking.candidates(f.s1, f.target, replace(S.DEFAULT, pair_tokens=None)))
query("b19_bounded_token_pairs", q(f"select distinct {PAIRS} from b16_pairs", rule_ctes("B16")))(lambda f: _only(f, "B16").distinct())


@query("b20_precomputed_keys", over("candidates", f"select {PAIRS} from candidates"))
def _precomputed(f):
    """The same candidates over key tables that an earlier run left, read by their paths."""
    paths = [folder(f.spark, name) for name in ("left", "right")]
    for path, df in zip(paths, (f.s1, f.target)):
        blocking.keyed(df).write.parquet(path)
    return blocking.chosen(*[f.spark.read.parquet(path) for path in paths], f.settings.top)


_KEYED = [r.id for r in S.RULES if r.evidence]
_TRUE = "select source1_entity_id, candidate_entity_id from truth"
_HITS = ",\n".join(
    [f"h_{r} as (select distinct t.* from ({_TRUE}) t join {r}_l a on a.entity_id = t.source1_entity_id and a.c join {r}_r b on b.entity_id = t.candidate_entity_id and b.k = a.k)" for r in map(str.lower, _KEYED)]
    + [f"h_{x} as (select distinct * from {x}_pairs)" for x in ("b15", "b16")]
)
_NUMBER = "ltrim(regexp_extract({}.address_norm, '([0-9]{{1,6}})', 1), '0')"
_FLAGS = (
    "flags as (select t.source1_entity_id, t.candidate_entity_id, a.country_norm as country, "
    + ", ".join(f"h_{x}.source1_entity_id is not null as hit_{x}" for x in [*map(str.lower, _KEYED), "b15", "b16"])
    + ", coalesce(n.same and left(replace(a.name_norm, ' ', ''), 4) = left(replace(b.name_norm, ' ', ''), 4), false) as hit_fold_number, coalesce(n.same and b.name_norm = '', false) as hit_nameless_number"
    + " from truth t join s1 a on a.entity_id = t.source1_entity_id join target b on b.entity_id = t.candidate_entity_id, "
    + f"lateral (select a.country_norm = b.country_norm and {_NUMBER.format('a')} <> '' and {_NUMBER.format('a')} = {_NUMBER.format('b')} as same) n "
    + " ".join(f"left join h_{x} on h_{x}.source1_entity_id = t.source1_entity_id and h_{x}.candidate_entity_id = t.candidate_entity_id" for x in [*map(str.lower, _KEYED), "b15", "b16"])
    + "),\nany_flag as (select *, "
    + " or ".join(diagnostics.OLD_FLAGS)
    + " as old from flags)"
)
_flag_ctes = (*[rule_ctes(r) for r in [*_KEYED, "B15", "B16"]], _HITS, _FLAGS)


def _flagged(f):
    return diagnostics.flagged(f.truth, f.s1, f.target)


_ALL = ", ".join((*diagnostics.OLD_FLAGS, *diagnostics.NEW_FLAGS))
query("b21_rule_flags", q(f"select {PAIRS}, country, {_ALL} from flags", *_flag_ctes))(_flagged)
query(
    "a07_recall_by_country",
    q(
        "select country, count(*) as total_pairs, count(*) filter (old) as before_pairs, round(count(*) filter (old) * 100.0 / count(*), 4)::double as before_pct, count(*) filter (old or hit_b15 or hit_b16) as after_pairs, round(count(*) filter (old or hit_b15 or hit_b16) * 100.0 / count(*), 4)::double as after_pct from any_flag group by 1",
        *_flag_ctes,
    ),
)(lambda f: diagnostics.recall_by_country(_flagged(f)))
# the fixture's truth has no pair that blocking misses, so each source entity gets a wrong one too
_MORE = "more as (select source1_entity_id, candidate_entity_id from truth union all select a.entity_id, b.entity_id from ent a join ent b on b.doc_id = a.doc_id + 1 where a.src = 0)"


@query("b22_missed_pairs", q(f"select {PAIRS} from any_flag where not (old or hit_b15 or hit_b16)", _MORE, *[c.replace("from truth", "from more") for c in _flag_ctes]))
def _missed(f):
    next_ = f.target.where("src = 1").select(F.col("entity_id").alias(S.PAIR[1]), (F.col("doc_id") - 1).alias("doc_id"))
    more = f.truth.union(f.s1.select(F.col("entity_id").alias(S.PAIR[0]), "doc_id").join(next_, "doc_id").select(*S.PAIR))
    return diagnostics.missed(diagnostics.flagged(more, f.s1, f.target)).select(*S.PAIR)


query("w09_flag_disjunction", q(f"select {PAIRS} from any_flag where old", *_flag_ctes))(lambda f: _flagged(f).where(diagnostics.any_of(diagnostics.OLD_FLAGS)).select(*S.PAIR))
query("b23_rule_attribution", q(f"select {PAIRS}, case when hit_b15 and hit_b16 then 'both' when hit_b15 then 'B15' when hit_b16 then 'B16' else 'none' end as rules from flags", *_flag_ctes))(lambda f: diagnostics.attribution(_flagged(f)))
query("a12_blocking_recall", over("labelled", "select sum(label)::bigint as hits, (select count(*) from truth) as truth, round(sum(label)::double / (select count(*) from truth), 6) as recall from labelled"))(
    lambda f: f.labelled.agg(F.sum("label").alias("hits")).join(f.truth.agg(F.count(F.lit(1)).alias("truth"))).select("hits", "truth", F.round(F.col("hits") / F.col("truth"), 6).alias("recall"))
)
_VOLUME = """v as (select count(*) as pairs, count(distinct source1_entity_id) as active, (select count(*) from s1) as n_s1, (select count(*) from target) as n_target from candidates)"""
query("a13_reduction_ratio", over("candidates", "select pairs, round(1 - pairs / (n_s1 * n_target), 6)::double as reduction from v", _VOLUME))(lambda f: diagnostics.volume(f.candidates, f.s1, f.target).select("pairs", "reduction"))
query("a14_volume", over("candidates", "select pairs, active, n_s1, n_target, round(pairs / n_s1, 6)::double as avg_all, round(pairs / greatest(1, active), 6)::double as avg_active, round(active * 100.0 / n_s1, 4)::double as coverage_pct, round(1 - pairs / (n_s1 * n_target), 6)::double as reduction from v", _VOLUME))(
    lambda f: diagnostics.volume(f.candidates, f.s1, f.target)
)

# --- the second blocker ------------------------------------------------------------------------

_POST = """w as (select *, regexp_extract_all(name_norm, '[a-z0-9]+') as toks, regexp_extract_all(address_norm, '[a-z0-9]+') as atoks from nrm where coalesce(country_norm, '') <> ''),
post as (
  select distinct entity_id, src, doc_id, country_norm as country, family, key from (
    select *, 'exact_name' as family, name_norm as key from w where name_norm <> ''
    union all select *, 'exact_addr', address_norm from w where address_norm <> ''
    union all select * from (select *, 'name_tok', unnest(toks) as t from w) where length(t) >= 2
    union all select *, 'name_prefix', left(toks[1], 4) from w where len(toks) > 0
    union all select * from (select *, 'addr_tok', unnest(atoks) as t from w) where length(t) >= 3
    union all select *, 'ngram', unnest(list_transform(range(1, length(name_norm) - 1), lambda i: substr(name_norm, i, 3))) from w where length(name_norm) >= 3
    union all select *, 'combo', left(toks[1], 4) || chr(1) || coalesce(list_filter(atoks, lambda t: regexp_matches(t, '[0-9]'))[1], atoks[1]) from w where len(toks) > 0 and len(atoks) > 0)),
index as (select * from (select *, row_number() over (partition by family, country, key order by src, doc_id) as rn from post where src <> 0) where rn <= 250),
msc as (
  select l.entity_id as source1_entity_id, r.entity_id as candidate_entity_id, r.src, r.doc_id,
         sum(case l.family when 'exact_name' then 8 when 'exact_addr' then 7 when 'combo' then 6 when 'name_prefix' then 5 when 'name_tok' then 4 when 'addr_tok' then 3 else 2 end)::bigint as score
  from post l join index r using (family, country, key) where l.src = 0 group by 1, 2, 3, 4),
mc as (select * from (select *, row_number() over (partition by source1_entity_id order by score desc, src, doc_id) as rn from msc) where rn <= 300)"""
_ORDER = ["src", "doc_id"]
query("m01_m05_posting_keys", q("select entity_id, country, family, key from post", _POST))(lambda f: postings.postings(X.normalised(f.source(0, 1, 2))).select("entity_id", "country", "family", "key"))
query("n06_posting_cap", q("select entity_id, country, family, key from index", _POST))(lambda f: postings.cut(postings.postings(f.target, *_ORDER), _ORDER, 250).select("entity_id", "country", "family", "key"))
query("m06_weighted_score", q(f"select {PAIRS}, score from msc", _POST))(lambda f: postings.scored(f.s1, f.target, _ORDER).select(*S.PAIR, "score"))
query("m07_postings_candidates", q(f"select {PAIRS} from mc", _POST))(lambda f: postings.candidates(f.s1, f.target, _ORDER))
query("n07_top_300_by_position", q(f"select {PAIRS} from (select *, row_number() over (partition by source1_entity_id order by score desc, src, doc_id) as r2 from msc) where r2 <= 300", _POST))(
    lambda f: postings.candidates(f.s1, f.target, _ORDER)
)
# the second blocker without its two cuts: what m07 leaves out is here
query("m07_unbounded_candidates", q("select distinct l.entity_id as source1_entity_id, r.entity_id as candidate_entity_id from post l join post r using (family, country, key) where l.src = 0 and r.src <> 0", _POST))(
    lambda f: postings.every_candidate(f.s1, f.target)
)
