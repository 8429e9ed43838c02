"""Queries on single operators: scans, scalar functions, predicates, sets, windows, aggregates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as X
from ..operators import labeling
from ..sources import delimited
from .registry import query
from .sql import _in, plain_words, q, replaced

# --- scalar functions -----------------------------------------------------------------------

query("f01_ascii_normalise", q("select entity_id, name_norm, address_norm from nrm"))(lambda f: X.normalised(f.entities).select("entity_id", "name_norm", "address_norm"))
query("f02_name_abbreviations", q(f"select entity_id, {replaced(plain_words('business_name'), S.NAME_ABBREVIATIONS)} as name_norm from ent"))(lambda f: f.entities.select("entity_id", X.name_norm(F.col("business_name")).alias("name_norm")))
query("f03_address_abbreviations", q(f"select entity_id, {replaced(plain_words('business_address'), S.ADDRESS_ABBREVIATIONS)} as address_norm from ent"))(
    lambda f: f.entities.select("entity_id", X.address_norm(F.col("business_address")).alias("address_norm"))
)
query(
    "f04_unicode_normalise",
    q("select entity_id, trim(regexp_replace(regexp_replace(lower(nfc_normalize(business_name)), '[^\\p{L}\\p{N}\\p{M}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) as base from ent"),
)(lambda f: f.entities.select("entity_id", X.unicode_base(F.col("business_name")).alias("base")))
_uni = lambda c: f"trim(regexp_replace(regexp_replace(lower(nfc_normalize(coalesce({c}, ''))), '[^\\p{{L}}\\p{{N}}\\p{{M}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _words(c: str) -> str:
    return f"string_split({_uni(c)}, ' ')"


query(
    "f05_preprocess_unicode",
    q(
        f"select entity_id, business_name, business_address, country, {replaced(_words('business_name'), S.NAME_ABBREVIATIONS)} as name_norm, {replaced(_words('business_address'), S.UNICODE_ADDRESS_ABBREVIATIONS)} as address_norm, {_uni('country')} as country_norm from ent"
    ),
)(lambda f: X.normalised(f.entities, "unicode").select("entity_id", "business_name", "business_address", "country", "name_norm", "address_norm", "country_norm"))
query("f06_country_normalise", q("select entity_id, lower(trim(country)) as country_norm from ent"))(lambda f: f.entities.select("entity_id", X.country_norm(F.col("country")).alias("country_norm")))
query("f07_prefix_keys", q("select entity_id, substr(split_part(name_norm, ' ', 1), 1, 4) as np, substr(split_part(address_norm, ' ', 1), 1, 4) as ap from nrm"))(
    lambda f: X.normalised(f.entities).select("entity_id", X.first_word(F.col("name_norm"), 4).alias("np"), X.first_word(F.col("address_norm"), 4).alias("ap"))
)
query(
    "f08_regexp_extract",
    q("select entity_id, regexp_extract(name_norm, '[a-z]{5,}', 0) as run5, regexp_extract(name_norm, '^[^ ]+ ([a-z]{4,})', 1) as second, regexp_extract(address_norm, '([0-9]{1,6})', 1) as num from nrm"),
)(
    lambda f: X.normalised(f.entities).select(
        "entity_id",
        F.regexp_extract("name_norm", "[a-z]{5,}", 0).alias("run5"),
        F.regexp_extract("name_norm", "^[^ ]+ ([a-z]{4,})", 1).alias("second"),
        F.regexp_extract("address_norm", "([0-9]{1,6})", 1).alias("num"),
    )
)
query("f09_regexp_extract_all", q("select entity_id, array_to_string(regexp_extract_all(address_norm, '[0-9]{1,6}'), ',') as nums from nrm"))(
    lambda f: X.normalised(f.entities).select("entity_id", F.array_join(F.regexp_extract_all("address_norm", F.lit("[0-9]{1,6}"), F.lit(0)), ",").alias("nums"))
)
query("f10_regexp_matches", q("select entity_id, token from (select entity_id, unnest(string_split(address_norm, ' ')) as token from nrm) where regexp_matches(token, '^[a-z]+$')"))(
    lambda f: X.normalised(f.entities).select("entity_id", F.explode(F.split("address_norm", " ")).alias("token")).where(F.col("token").rlike("^[a-z]+$"))
)
query("f11_string_split", q("select entity_id, len(string_split(name_norm, ' '))::bigint as n from nrm"))(lambda f: X.normalised(f.entities).select("entity_id", F.size(F.split("name_norm", " ")).cast("long").alias("n")))
query("f12_strip_leading_zeros", q("select entity_id, ltrim(regexp_extract(address_norm, '([0-9]{1,6})', 1), '0') as num from nrm"))(lambda f: X.normalised(f.entities).select("entity_id", X.first_number(F.col("address_norm")).alias("num")))
query("f13_fold_spaces", q("select entity_id, substr(replace(name_norm, ' ', ''), 1, 4) as fold from nrm"))(
    lambda f: X.normalised(f.entities).select("entity_id", F.substring(F.replace("name_norm", F.lit(" "), F.lit("")), 1, 4).alias("fold"))
)
query("f14_length_lower_trim", q("select entity_id, length(business_name)::bigint as n, lower(business_name) as low, trim(business_address) as trimmed, coalesce(country, '?') as country, cast(doc_id as varchar) as id from ent"))(
    lambda f: f.entities.select(
        "entity_id", F.length("business_name").cast("long").alias("n"), F.lower("business_name").alias("low"), F.trim("business_address").alias("trimmed"), F.coalesce("country", F.lit("?")).alias("country"), F.col("doc_id").cast("string").alias("id")
    )
)
query("f15_hash_order", q("select entity_id, md5(entity_id) as h, row_number() over (order by md5(entity_id)) as rn from ent"))(
    lambda f: f.entities.select("entity_id", F.md5("entity_id").alias("h"), F.row_number().over(Window.orderBy(F.md5("entity_id"))).alias("rn"))
)
query("f16_case_flags", q("select entity_id, case when business_name = '' then 1 else 0 end as nameless, case when country is not null then 1 else 0 end as placed from ent"))(
    lambda f: f.entities.select("entity_id", F.when(F.col("business_name") == "", 1).otherwise(0).alias("nameless"), F.when(F.col("country").isNotNull(), 1).otherwise(0).alias("placed"))
)
query(
    "f17_round_ceil_mod",
    q("select country, round(count(*) filter (business_name = '') * 100.0 / count(*), 4)::double as pct, ceil(count(*) * 0.10)::bigint as tenth, (count(*) % 5)::bigint as rest from ent group by country"),
)(
    lambda f: f.entities.groupBy("country").agg(
        F.round(F.count_if(F.col("business_name") == "") * 100.0 / F.count(F.lit(1)), 4).alias("pct"), F.ceil(F.count(F.lit(1)) * 0.10).alias("tenth"), (F.count(F.lit(1)) % 5).alias("rest")
    )
)
query("f18_exclude_column", q("select entity_id, business_name from (select * exclude (business_address, country, src, doc_id, digest) from ent)"))(lambda f: f.entities.drop("business_address", "country", "src", "doc_id", "digest"))
query(
    "f20_token_sets",
    q(
        "select entity_id, len(list_distinct(regexp_extract_all(address_norm, '[a-z0-9]+')))::bigint as n_tokens, len(list_filter(list_distinct(regexp_extract_all(address_norm, '[a-z0-9]+')), lambda t: regexp_matches(t, '[0-9]')))::bigint as n_numbers, "
        "len(list_distinct(list_transform(range(1, length(name_norm) + 3), lambda i: substr('  ' || name_norm || '  ', i, 3))))::bigint as n_grams from nrm"
    ),
)(
    lambda f: X.normalised(f.entities).select(
        "entity_id",
        F.size(X.token_set(F.col("address_norm"))).cast("long").alias("n_tokens"),
        F.size(F.filter(X.token_set(F.col("address_norm")), lambda t: t.rlike("[0-9]"))).cast("long").alias("n_numbers"),
        F.size(X.trigrams(F.col("name_norm"))).cast("long").alias("n_grams"),
    )
)
query("f21_levenshtein", q("select entity_id, levenshtein(name_norm, address_norm)::bigint as lev from nrm"))(lambda f: X.normalised(f.entities).select("entity_id", F.levenshtein("name_norm", "address_norm").cast("long").alias("lev")))

# --- predicates ----------------------------------------------------------------------------

query("w01_non_empty", q("select entity_id from nrm where name_norm <> '' and country_norm <> ''"))(lambda f: X.normalised(f.entities).where("name_norm <> '' and country_norm <> ''").select("entity_id"))
query("w02_minimum_length", q("select entity_id from nrm where length(name_norm) >= 3 and length(address_norm) >= 4"))(lambda f: X.normalised(f.entities).where("length(name_norm) >= 3 and length(address_norm) >= 4").select("entity_id"))
query("w03_stop_words", q(f"select entity_id, regexp_extract(name_norm, '^[^ ]+ ([a-z]{{4,}})', 1) as token from nrm where regexp_extract(name_norm, '^[^ ]+ ([a-z]{{4,}})', 1) not in {_in(S.SECOND_WORD_STOPS)}"))(
    lambda f: X.normalised(f.entities).select("entity_id", F.regexp_extract("name_norm", "^[^ ]+ ([a-z]{4,})", 1).alias("token")).where(~F.col("token").isin(*S.SECOND_WORD_STOPS))
)
query("w05_null_or_empty", q("select entity_id from nrm where name_norm is null or name_norm = '' or country_norm is null"))(lambda f: X.normalised(f.entities).where("name_norm is null or name_norm = '' or country_norm is null").select("entity_id"))
query("w08_keyset_resume", q("select entity_id, business_name from ent where entity_id > 'S1-3' order by entity_id limit 50"))(lambda f: f.entities.where("entity_id > 'S1-3'").orderBy("entity_id").limit(50).select("entity_id", "business_name"))
query("w10_prefix_tests", q("select entity_id from ent where starts_with(entity_id, 'S2-') or starts_with(entity_id, 'S3-')"))(lambda f: f.entities.where(F.col("entity_id").startswith("S2-") | F.col("entity_id").startswith("S3-")).select("entity_id"))

# --- sorts, limits, samples, sets ------------------------------------------------------------

query("l01_order_by", q("select entity_id, row_number() over (order by country_norm nulls first, entity_id) as pos from nrm"))(
    lambda f: X.normalised(f.entities).select("entity_id", F.row_number().over(Window.orderBy(F.col("country_norm").asc_nulls_first(), "entity_id")).alias("pos"))
)
query("l02_hash_sample", q("select entity_id from s1 order by md5(entity_id), entity_id limit 100"))(lambda f: labeling.sample(f.s1, 100).select("entity_id"))
query("l03_ordered_limit", q("select entity_id from target order by entity_id limit 25"))(lambda f: f.target.orderBy("entity_id").limit(25).select("entity_id"))
query("l04_sample_per_country", q("select entity_id, country_norm from (select *, row_number() over (partition by country_norm order by md5(entity_id)) as rn from nrm) where rn <= 10"))(
    lambda f: labeling.per_group(X.normalised(f.entities), 10).select("entity_id", "country_norm")
)
query("l05_group_split", q("select entity_id, ('0x' || substr(md5(entity_id), 1, 7))::bigint % 5 as part from s1"))(lambda f: f.s1.select("entity_id", labeling.bucket("entity_id", 5).alias("part")))
query("u01_union_all", q("select entity_id, name_norm from target"))(lambda f: f.target.select("entity_id", "name_norm"))
query("u03_distinct", q("select distinct country_norm, substr(name_norm, 1, 2) as start from nrm"))(lambda f: X.normalised(f.entities).select("country_norm", F.substring("name_norm", 1, 2).alias("start")).distinct())
query("u04_set_difference", q("select name_norm from s1 except select name_norm from target"))(lambda f: f.s1.select("name_norm").distinct().join(f.target.select("name_norm"), "name_norm", "left_anti"))
query(
    "u05_set_union_intersection",
    q("select entity_id, len(list_distinct(list_concat(a, b)))::bigint as n_union, len(list_intersect(a, b))::bigint as n_both from (select entity_id, list_distinct(regexp_extract_all(name_norm, '[a-z0-9]+')) as a, list_distinct(regexp_extract_all(address_norm, '[a-z0-9]+')) as b from nrm)"),
)(
    lambda f: X.normalised(f.entities).select(
        "entity_id",
        F.size(F.array_union(X.token_set(F.col("name_norm")), X.token_set(F.col("address_norm")))).cast("long").alias("n_union"),
        F.size(F.array_intersect(X.token_set(F.col("name_norm")), X.token_set(F.col("address_norm")))).cast("long").alias("n_both"),
    )
)
query("u06_unnest", q("select entity_id, unnest(string_split(address_norm, ' ')) as token from nrm"))(lambda f: X.normalised(f.entities).select("entity_id", F.explode(F.split("address_norm", " ")).alias("token")))
query("u07_cte_chain", q("select c.country_norm, c.n, c.n * 100 // t.n as pct from c, t", "c as (select country_norm, count(*) as n from nrm group by 1)", "t as (select sum(n)::bigint as n from c)"))(
    lambda f: f.spark.sql(
        "with c as (select country_norm, count(*) as n from {e} group by 1), t as (select sum(n) as n from c) select country_norm, n, n * 100 div (select n from t) as pct from c", e=X.normalised(f.entities)
    )
)

# --- windows ------------------------------------------------------------------------------

query(
    "n02_nth_longest_token",
    q(
        "select entity_id, token from t where rn = 2",
        f"t as (select entity_id, token, row_number() over (partition by entity_id order by length(token) desc, token) as rn from (select entity_id, unnest(string_split(name_norm, ' ')) as token from nrm) where length(token) >= 5 and token not in {_in(S.NAME_TOKEN_STOPS)})",
    ),
)(lambda f: X.normalised(f.entities).select("entity_id", F.get(X.name_tokens(F.col("name_norm")), F.lit(1)).alias("token")).where("token is not null"))
query("n04_folds", q("select entity_id, (row_number() over (order by md5(entity_id), entity_id) % 5)::bigint as split from s1"))(lambda f: labeling.folds(f.s1))
query(
    "n05_stratified_sample",
    q("select entity_id, country_norm from (select *, row_number() over (partition by country_norm order by md5(entity_id)) as rn, count(*) over (partition by country_norm) as cnt from s1) where rn <= ceil(cnt * 0.10)"),
)(lambda f: labeling.stratified(f.s1, 0.10).select("entity_id", "country_norm"))

# --- aggregates ---------------------------------------------------------------------------

query("a01_count", q("select count(*) as n from nrm"))(lambda f: f.entities.agg(F.count(F.lit(1)).alias("n")))
query("a02_key_frequencies", q("select country_norm, name_norm, count(*) as n from target where name_norm <> '' group by 1, 2"))(lambda f: f.target.where("name_norm <> ''").groupBy("country_norm", "name_norm").agg(F.count(F.lit(1)).alias("n")))
query("a03_token_frequencies", q("select country_norm, regexp_extract(name_norm, '[a-z]{5,}', 0) as token, count(*) as n from target where regexp_extract(name_norm, '[a-z]{5,}', 0) <> '' group by 1, 2"))(
    lambda f: f.target.select("country_norm", F.regexp_extract("name_norm", "[a-z]{5,}", 0).alias("token")).where("token <> ''").groupBy("country_norm", "token").agg(F.count(F.lit(1)).alias("n"))
)
query("a06_count_distinct", q("select count(distinct name_norm) as names, count(distinct country_norm) as countries from nrm"))(lambda f: X.normalised(f.entities).agg(F.countDistinct("name_norm").alias("names"), F.countDistinct("country_norm").alias("countries")))
query("a10_missing_counts", q("select c as column, n as rows, m as missing from (select count(*) as n, count(*) filter (coalesce(business_name, '') = '') as b, count(*) filter (coalesce(country, '') = '') as k, count(*) filter (coalesce(entity_id, '') = '') as e, count(*) filter (coalesce(business_address, '') = '') as a from ent), lateral (values ('entity_id', e), ('business_name', b), ('business_address', a), ('country', k)) v(c, m)"))(
    lambda f: delimited.missing_counts(f.entities.select("entity_id", "business_name", "business_address", "country"))
)
query("a16_duplicates", q("select name_norm, count(*) as n from nrm group by 1 having count(*) > 1"))(lambda f: X.normalised(f.entities).groupBy("name_norm").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))

# --- scans over tables and views --------------------------------------------------------------

query("s07_table_scan", "select doc_id, lang, n_chars from documents where n_chars > 500")(lambda f: f.spark.read.parquet(f"{f.dir}/documents.parquet").where("n_chars > 500").select("doc_id", "lang", "n_chars"))


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query("s08_catalog_scan", f"select table_name as name, column_name as column from information_schema.columns where table_name in {_in(TABLES)}")
def _catalog(f):
    """Tables and columns as the session's catalog lists them, once they are registered."""
    for t in TABLES:
        f.spark.read.parquet(f"{f.dir}/{t}.parquet").createOrReplaceTempView(f"kinmatch_{t}")
    catalog = f.spark.catalog
    try:
        names = [t.name for t in catalog.listTables() if t.isTemporary and t.name.startswith("kinmatch_")]
        rows = [(n.removeprefix("kinmatch_"), c.name) for n in names for c in catalog.listColumns(n)]
    finally:
        for t in TABLES:
            catalog.dropTempView(f"kinmatch_{t}")
    return f.spark.createDataFrame(rows, "name string, column string")


@query("s09_registered_frame", q("select entity_id from nrm join (values ('S1-3'), ('S2-4'), ('S3-5')) v(id) on id = entity_id"))
def _registered(f):
    ids = f.spark.createDataFrame([("S1-3",), ("S2-4",), ("S3-5",)], "id string")
    return f.spark.sql("select e.entity_id from {e} e join {ids} on id = entity_id", e=f.entities, ids=ids)


query("s10_bound_parameters", q("select entity_id from ent where country = 'en' and length(business_name) >= 20"))(
    lambda f: f.spark.sql("select entity_id from {e} where country = :country and length(business_name) >= :least", args={"country": "en", "least": 20}, e=f.entities)
)
