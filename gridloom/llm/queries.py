"""One query per operator on the given tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import bwt as op3
from gridloom.llm import decontaminate as op1
from gridloom.llm import html_blocks as op13
from gridloom.llm import html_samples
from gridloom.llm import kdshard as op10
from gridloom.llm import ngram_join as op5
from gridloom.llm import orchard as op12
from gridloom.llm import order_minhash as op4
from gridloom.llm import packing as op7
from gridloom.llm import quality as op6
from gridloom.llm import spelling as op11
from gridloom.llm import substring as op2
from gridloom.llm import toxicity as op9
from gridloom.llm import warc as op8

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    return op1.digest(op1.decontaminate(docs, items))


OP1_SQL = r"""
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (
  select item_id::varchar as item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark where text is not null),
bw as (
  select distinct item, size, array_to_string(ws[i:i + size - 1], ' ') as win
  from (select item, ws, least(10, len(ws)) as size from b where len(ws) > 0) x, unnest(range(1, len(ws) - size + 2)) t(i)),
dw as (
  select doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') as win
  from w, (select distinct size from bw) s, unnest(range(1, len(ws) - size + 2)) t(i)),
occ as (select doc_id, i, dw.size, item from dw join bw using (win, size)),
hit as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + size)) as p from (select distinct doc_id, i, size from occ)) group by doc_id),
its as (select doc_id, count(distinct item) as n, string_agg(distinct item, ',' order by item) as ids from occ group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, coalesce(hit.n, 0)::bigint as n_hit, coalesce(its.n, 0)::bigint as n_items,
       sha256(coalesce(its.ids, '')) as items_sha256, coalesce(hit.n, 0) > 0 as contaminated
from w left join hit using (doc_id) left join its using (doc_id)
"""


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5.join(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
sh as (
  select distinct doc_id, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') as g
  from w, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) t(i) where len(ws) > 0),
n as (select doc_id, count(*) as n from sh group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b using (g) where a.doc_id <> b.doc_id group by 1, 2),
link as (select a, b from common join n na on na.doc_id = a join n nb on nb.doc_id = b where c >= 0.8 * (na.n + nb.n - c) - 1e-6),
reach as (select a, b from link union select r.a, l.b from reach r join link l on l.a = r.b)
select doc_id, least(doc_id, coalesce((select min(b) from reach where a = doc_id), doc_id)) as class_id,
       coalesce((select count(*) from link where a = doc_id), 0)::bigint as n_links
from documents
"""


def op6_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op6.digest(op6.score(docs, op6.fit(docs, table(spark, sf_dir, "labels"))))


def op9_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op9.digest(op9.score(docs, op9.fit(docs, table(spark, sf_dir, "labels"))))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.digest(op2.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.digest(op3.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.fingerprints(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.digest(op7.pack(table(spark, sf_dir, "documents")))


def op8_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages against a replica of them that lacks some records and has others altered."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    replica = pages.where("page_id % 499 != 3").withColumn(
        "html", F.when(F.col("page_id") % 101 == 7, F.expr("concat(substr(html, 2), 'x')")).otherwise(F.col("html"))
    )
    found = op8.audit(pages, replica)
    return found.select(F.col("id").alias("page_id"), "place", "offset", "length", "digest", "replica_digest", "status")


OP8_SQL = """
with r as (select page_id, chr(13) || chr(10) as nl, coalesce(url, '') as url, coalesce(html, '') as html from pages),
rec as (
  select page_id, url, html, nl,
    'WARC/1.1' || nl || 'WARC-Type: response' || nl || 'WARC-Target-URI: ' || url || nl || 'Content-Length: ' || strlen(html) || nl || nl || html || nl || nl as raw,
    case when page_id % 101 = 7 then substr(html, 2) || 'x' else html end as html2 from r),
both_ as (
  select *, 'WARC/1.1' || nl || 'WARC-Type: response' || nl || 'WARC-Target-URI: ' || url || nl || 'Content-Length: ' || strlen(html2) || nl || nl || html2 || nl || nl as raw2
  from rec),
put as (
  select page_id, row_number() over (order by page_id) - 1 as place,
    (sum(strlen(raw)) over (order by page_id) - strlen(raw))::bigint as "offset", strlen(raw) as length, sha256(raw) as digest,
    case when page_id % 499 <> 3 then sha256(raw2) end as replica_digest from both_)
select *, case when replica_digest is null then 'missing' else 'changed' end as status
from put where replica_digest is distinct from digest
"""


def op10_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.digest(op10.assign(table(spark, sf_dir, "documents"), shards=24))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.variants(table(spark, sf_dir, "documents"))


def _crc32_steps() -> str:
    """The 256 steps of CRC-32 as an SQL list, from its polynomial."""
    steps = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        steps.append(f"{value}::ubigint")
    return f"[{', '.join(steps)}]"


OP11_SQL = rf"""
with recursive docs as (
  select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as run from documents),
runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as k from docs group by 1, 2),
bytes as (
  select doc_id, run, k, list_transform(flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
    lambda c: case when ord(c) < 128 then [ord(c)] else [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] end)), lambda b: b::ubigint) as bs
  from runs where length(run) >= 6),
hashed as (
  select run, k, length(run) as size, xor(4294967295::ubigint, list_reduce(list_prepend(4294967295::ubigint, bs),
    lambda c, b: xor(c >> 8, {_crc32_steps()}[((xor(c, b) & 255) + 1)::bigint]))) as h from bytes),
words as (
  select case when h % 199 = 0 then run[1:h % size] || run[h % size + 2:] else run end as word, sum(k)::bigint as n from hashed group by 1),
v as (select * from words where length(word) >= 6 and n >= 5),
gone as (select word, n, i::bigint as i, word[1:i - 1] || word[i + 1:] as rest from v, unnest(range(1, length(word) + 1)) t(i)),
pairs as (
  select a.word, b.word as other, b.n as other_n from gone a join gone b using (i, rest) where a.word <> b.word
  union select a.word, b.word, b.n from (select distinct word, rest from gone) a join v b on a.rest = b.word
  union select b.word, a.word, a.n from (select distinct word, n, rest from gone) a join v b on a.rest = b.word),
best as (
  select word, count(*) as n_near, arg_min(other, (-other_n, other)) as other, max(other_n) as other_n from pairs group by word),
f as (
  select v.word, v.n, coalesce(n_near, 0)::bigint as n_near, case when other_n >= 5 * v.n then other end as form,
    case when other_n >= 5 * v.n then other_n end as form_n from v left join best using (word)),
walk as (select word, word as spot, 0 as step from f union all select w.word, f.form, step + 1 from walk w join f on f.word = w.spot where f.form is not null)
select f.word, n, n_near, form, form_n::bigint as form_n, ends.root
from f join (select word, arg_max(spot, step) as root from walk group by word) ends on ends.word = f.word
"""


def op12_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.digest(op12.cluster(table(spark, sf_dir, "embeddings")))


def _op12_sql() -> str:
    steps = ["""
with raw as (select vec_id, row_number() over () as r, embedding from embeddings where len(embedding) = 64),
k as (
  select vec_id, r, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from raw
  where len(list_filter(embedding, lambda x: x is not null and isfinite(x) and abs(x::double) < 262144)) = 64),
c0 as (select row_number() over (order by sha256('1:' || vec_id::varchar), v) - 1 as c, v from k where vec_id is not null order by c limit 16)"""]
    for i in range(4):
        steps.append(f"""
d{i} as (
  select vec_id, r, k.v, c, list_sum(list_transform(list_zip(k.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d from k, c{i}),
a{i} as (select vec_id, r, any_value(v) as v, min((d, c)) as best from d{i} group by vec_id, r)""")
        if i < 3:
            steps.append(f"""
m{i} as (
  select best[2] as c, i, sum(v[i])::bigint as s, count(*) as n from a{i}, unnest(range(1, 65)) t(i) group by 1, 2),
c{i + 1} as (
  select c{i}.c, coalesce(x.v, c{i}.v) as v from c{i} left join (
    select c, list((s - ((s % n) + n) % n) // n order by i) as v from m{i} group by c) x using (c))""")
    steps.append("""
u as (select best[2] as c, sum(best[1])::bigint as s from a3 group by 1)
select vec_id, best[2]::int as cluster, best[1]::bigint as distance, u.s as cluster_inertia, (select sum(s) from u)::bigint as inertia,
  sha256(array_to_string(c3.v, ',')) as centroid_sha256
from a3 join u on u.c = best[2] join c3 on c3.c = best[2]""")
    return ",".join(steps)


OP12_SQL = _op12_sql()


def op13_article_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = op13.fit(html_samples.samples(spark))
    return op13.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), tree)


QUERIES: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_order_minhash": op4_order_minhash,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_bradley_terry_quality": op6_bradley_terry_quality,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_merkle_audit": op8_merkle_audit,
    "op9_toxicity_lexicon": op9_toxicity_lexicon,
    "op10_kd_sharding": op10_kd_sharding,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_orchard_clusters": op12_orchard_clusters,
    "op13_article_text": op13_article_text,
}
ORACLES: dict[str, str] = {
    "op1_decontaminate": OP1_SQL, "op5_ngram_jaccard_join": OP5_SQL, "op8_merkle_audit": OP8_SQL,
    "op11_spelling_variants": OP11_SQL, "op12_orchard_clusters": OP12_SQL,
}
