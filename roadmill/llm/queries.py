"""The ten operators as queries over the given tables, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import block_naming, circulant, containment, exact_shards, mixture, template_html, token_blocks, unit_dedup, url_reputation, weak_quality
from .common import table

TOKENIZER_FILE = "word_bpe_49k.json"
END_ID = 1
RULES = [
    url_reputation.Rule("allow", "com/"),
    url_reputation.Rule("block", "example.com/en/"),
    url_reputation.Rule("allow", "www.example.com/en/"),
    url_reputation.Rule("block", "net/es/"),
    url_reputation.Rule("block", "net/fr/"),
]


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: a page is of the document whose number its path ends with; that document's quality label, if it has
    one, is the page's outcome."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("good"))
    host, path = url_reputation.url_parts(F.col("url"))
    number = F.regexp_extract(path, r"/([0-9]{1,18})(?:[./]|$)", 1)
    keyed = pages.select(host.alias("host"), F.when(number != "", number).cast("long").alias("doc_id"))
    outcomes = keyed.where("doc_id is not null").join(labels, "doc_id").select("host", "good")
    return url_reputation.judge_urls(pages, outcomes, RULES)


def op2_elias_fano_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = token_blocks.write_blocks(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), END_ID)
    return token_blocks.read_documents(blocks)


def op3_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = weak_quality.classify(docs, weak_quality.fit(docs))
    return scored.select("doc_id", "pattern", F.round("weak_posterior", 6).alias("weak_posterior"), F.round("score", 6).alias("score"), "keep")


def op4_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_html.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_shards.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), n_shards=24)


def op6_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixture.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op7_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, percent=80)


def op9_unit_hash_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = containment.contaminated(docs, items.select("item_id", "text"))
    return found.select("doc_id", "item_id", F.col("n_shared").cast("long").alias("n_shared"), F.col("n_shingles").cast("long").alias("n_shingles"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_host_reputation, op2_elias_fano_tokens, op3_weak_label_quality, op4_template_text, op5_hypergeometric_shards,
        op6_hash_threshold_mix, op7_block_naming, op8_circulant_minhash, op9_unit_hash_repeats, op10_benchmark_containment,
    )
    return {f.__name__: f for f in found}


# ---------------------------------------------------------------- SQL

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = rf"""
with p as (
  select page_id, coalesce(case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end, '') as rest from pages
), j as (
  select page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*', 0)")} as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from p
), l as (
  select doc_id, max(quality) as good from labels group by 1
), k as (
  select page_id, host, try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:[./]|$)', 1), '') as bigint) as doc_id from j
), h0 as (
  select host, count(good)::double as n, coalesce(sum(good), 0)::double as x from k left join l using (doc_id) group by 1
), h as (
  select *, coalesce(nullif(regexp_extract(host, '(?:^|\.)([^.]+\.(?:(?:co|com|ac|gov|org|net)\.[a-z]{{2}}|[^.]+))$', 1), ''), host) as dom,
    regexp_extract(host, '(?:^|\.)((?:co|com|ac|gov|org|net)\.[a-z]{{2}}|[^.]+)$', 1) as suf from h0
), d as (
  select dom, suf, sum(n) as n, sum(x) as x from h group by 1, 2
), s as (
  select suf, sum(n) as n, sum(x) as x from d group by 1
), m as (
  select (coalesce(sum(x), 0) + 0.5::double) / (coalesce(sum(n), 0) + 1.0::double) as m0 from s
), ks as (
  select case when b > 0 then least(greatest(a / b, 0.001::double), 0.999::double) else 0.001::double end as rho from (
    select sum(((x - n * m0) * (x - n * m0) / (m0 * (1 - m0)) - n) / n) as a, sum(n - 1) as b from s, m where n > 1 and m0 > 0 and m0 < 1)
), s1 as (
  select suf, (m0 * (1 - rho) / rho + x) / (n + (1 - rho) / rho) as m1 from s, m, ks
), d0 as (
  select d.*, m1 from d join s1 using (suf)
), kd as (
  select case when b > 0 then least(greatest(a / b, 0.001::double), 0.999::double) else 0.001::double end as rho from (
    select sum(((x - n * m1) * (x - n * m1) / (m1 * (1 - m1)) - n) / n) as a, sum(n - 1) as b from d0 where n > 1 and m1 > 0 and m1 < 1)
), d1 as (
  select dom, suf, (m1 * (1 - rho) / rho + x) / (n + (1 - rho) / rho) as m2 from d0, kd
), h1 as (
  select h.*, m2 from h join d1 using (dom, suf)
), kh as (
  select case when b > 0 then least(greatest(a / b, 0.001::double), 0.999::double) else 0.001::double end as rho from (
    select sum(((x - n * m2) * (x - n * m2) / (m2 * (1 - m2)) - n) / n) as a, sum(n - 1) as b from h1 where n > 1 and m2 > 0 and m2 < 1)
), r0 as (
  select host, mean, mean * size as a, (1 - mean) * size as b from (
    select host, (m2 * (1 - rho) / rho + x) / (n + (1 - rho) / rho) as mean, n + (1 - rho) / rho as size from h1, kh)
), r1 as (
  select host, a, b, i, sum(case when i = 0 then 0 else ln((a + b + i - 1) / (a + i) * 0.5::double) end) over (partition by host order by i) as l from r0, range(0, 6000) t(i)
), r as (
  select host, any_value(mean) as mean, exp(lgamma(any_value(r0.a) + any_value(r0.b)) - lgamma(any_value(r0.a)) - lgamma(any_value(r0.b)) + (any_value(r0.a) + any_value(r0.b)) * ln(0.5::double) - ln(any_value(r0.a)) + ln(sum(exp(l - top))) + any_value(top)) as bad
  from r0 join (select *, max(l) over (partition by host) as top from r1) using (host) group by host
), v as (
  select page_id, host, path, mean, bad,
    case when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
         when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
         when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
         when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
         when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/' end as rule
  from j join r using (host)
)
select page_id, host, path, rule,
  case when rule in ('www.example.com/en/', 'com/') then 'allow' when rule is not null then 'block' when bad > 0.95 then 'block' else 'allow' end as verdict,
  round(mean, 6) as posterior_mean, round(bad, 6) as posterior_bad from v
"""

_OP6 = r"""
with r as (
  select doc_id, coalesce('s' || source, 'n') as src, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    ('0x' || substr(md5(concat_ws('|', doc_id::varchar, source, md5(text))), 1, 9))::bigint as h
  from documents
), s0 as (
  select src, sum(size)::bigint as source_size from r group by 1
), s1 as (
  select *, row_number() over (order by src = 'n', encode(src)) - 1 as place from s0
), s2 as (
  select *, ([5, 2, 1])[(place % 3 + 1)::int]::bigint as w, source_size * 2.0::double as cap from s1
), s3 as (
  select *, sum(source_size) over () * 1.5::double as total, sum(w) over () as total_w,
    sum(source_size) over (order by source_size::double / w, place) - source_size as size_before, sum(w) over (order by source_size::double / w, place) - w as w_before from s2
), s4 as (
  select *, (total - size_before * 2.0::double) / (total_w - w_before) as lv from s3
), s5 as (
  select *, (select q.lv from s4 q where q.lv * q.w <= q.cap order by q.source_size::double / q.w, q.place limit 1) as level from s4
), s6 as (
  select src, source_size, coalesce(least(level * w, cap), cap) as target from s5
), s7 as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from s6
), g as (
  select *, (target - whole * source_size) / greatest(source_size, 1) as rest from s7
), c as (
  select r.*, case when size * 32 > source_size then 0 when size * 512 > source_size then 1 else 2 end as stratum from r join g using (src)
), t as (
  select src, coalesce(sum(size) filter (stratum <= 0), 0)::bigint as upto0, coalesce(sum(size) filter (stratum <= 1), 0)::bigint as upto1, sum(size)::bigint as upto2 from c group by 1
), u as (
  select *, sum(size) over (partition by src, stratum order by h range between unbounded preceding and current row) as upto, sum(size) over (partition by src, stratum, h) as here from c
), g0 as (
  select g.*, upto0, upto1, upto2, rest * upto0 as left0 from g join t using (src)
), g1 as (
  select g0.*, rest * upto1 - coalesce((select max(upto) from u where u.src = g0.src and stratum = 0 and (upto <= left0 or 2 * upto - here < 2 * left0)), 0) as left1 from g0
), g2 as (
  select g1.*, rest * upto2 - coalesce((select max(upto) from u where u.src = g1.src and stratum = 0 and (upto <= left0 or 2 * upto - here < 2 * left0)), 0) - coalesce((select max(upto) from u where u.src = g1.src and stratum = 1 and (upto <= left1 or 2 * upto - here < 2 * left1)), 0) as left2 from g1
)
select doc_id, size, source_size, target, size * least(whole + (upto <= goal or 2 * upto - here < 2 * goal)::bigint, 2) as taken
from (select u.*, source_size, target, whole, case stratum when 0 then left0 when 1 then left1 else left2 end as goal from u join g2 using (src))
"""

_OP7 = r"""
with n as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents
), g as (
  select text_sha256, min(doc_id) as keep_id, count(*) as group_size from n group by 1
)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256 from n join g using (text_sha256)
"""


def _shingle_sql(table_name: str, key: str, size: int) -> str:
    return rf"""
  select {key}, list_distinct(case when len(w) = 0 then [] else list_transform(range(1, greatest(len(w) - {size - 1}, 1) + 1), lambda i: array_to_string(w[i:i + {size - 1}], ' ')) end) as s
  from (select {key}, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') as w from {table_name})"""


_OP8 = rf"""
with recursive d as ({_shingle_sql("documents", "doc_id", 4)}
), u as (
  select doc_id, unnest(s) as x from d
), c as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from u a join u b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2
), l as (
  select a, b from c join d da on da.doc_id = a join d db on db.doc_id = b where 100 * n >= 80 * (len(da.s) + len(db.s) - n)
), e as (
  select a, b from l union all select b, a from l
), r as (
  select doc_id as node, doc_id as seen from d union select r.node, e.b from r join e on e.a = r.seen
), m as (
  select node, min(seen) as component_id from r group by 1
)
select doc_id, len(s)::bigint as n_shingles, component_id, doc_id = component_id as kept from d join m on m.node = doc_id
"""

_OP10 = rf"""
with d as ({_shingle_sql("documents", "doc_id", 5)}
), b as ({_shingle_sql("benchmark", "item_id", 5)}
), u as (
  select doc_id, unnest(s) as x from d
), q as (
  select item_id, len(s) as n_shingles, unnest(s) as x from b
)
select doc_id, item_id, count(*) as n_shared, n_shingles::bigint as n_shingles from u join q using (x) group by doc_id, item_id, n_shingles having count(*) * 100 >= n_shingles * 80
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_host_reputation": _OP1,
        "op6_hash_threshold_mix": _OP6,
        "op7_block_naming": _OP7,
        "op8_circulant_minhash": _OP8,
        "op10_benchmark_containment": _OP10,
    }
