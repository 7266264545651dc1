"""Queries opN_<name> over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, jaccard, mixing, pii, substring, topk, toxicity, url_reputation, vector_dedup, warc
from .common import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source at the same weight, as many documents as there are."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


OP4_SQL = f"""
with c as (select source, count(*)::double n from documents group by source),
  r as (select source, (select sum(n) from c) * 1.0::double / (select count(*) from c)::double / n rate from c),
  terms as (select source, rate, j, exp(-rate + j * ln(rate) - lgamma(j + 1)) p from r, generate_series(0, {mixing.TERMS}) t(j)),
  cdf as (select source, j, sum(p) over (partition by source order by j) c from terms),
  u as (select *, (('0x' || substr(sha256('mix:' || doc_id::varchar), 1, 13))::bigint::double + 0.5) / {float(1 << 52)!r} u from documents),
  k as (select u.doc_id, u.text, u.lang, u.source, u.n_chars, count(*) n from u join cdf on u.source is not distinct from cdf.source and cdf.c <= u.u group by all)
select doc_id, text, lang, source, n_chars, i::int as "copy", sha256('mix:' || doc_id::varchar || '/' || i::varchar) as mix_key
from k, lateral (select unnest(generate_series(1, n)) i)
"""


def op6_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.filter_urls(table(spark, sf_dir, "pages"), url_reputation.page_outcomes(table(spark, sf_dir, "labels")))


OP6_SQL = f"""
with pg as (select page_id, translate(coalesce(regexp_extract(url, '{url_reputation.PARTS}', 1), ''), '{url_reputation.UPPER}', '{url_reputation.LOWER}') host,
    coalesce(regexp_extract(url, '{url_reputation.PARTS}', 2), '') path from pages),
  oc as (select doc_id as page_id, (toxic = 1 or quality = 0)::int bad from labels where (toxic = 1 or quality = 0) is not null),
  ct as ({url_reputation.COUNTS.format(pages='pg', outcomes='oc')}),
  rep as ({url_reputation.REPUTATION.format(counts='ct')})
select page_id, host, path, {url_reputation.rule_sql(of=1)} as rule,
  coalesce({url_reputation.rule_sql(of=0)}, case when low > {url_reputation.LIMIT} then 'block' else 'allow' end) as verdict, rate, low
from pg left join rep on host = r_host
"""


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = warc.round_trip(table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
with p as (select page_id, strlen(coalesce(html, '')) payload_bytes, sha1(coalesce(html, '')) payload_digest, url from pages),
  m as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest, payload_bytes) end rep from p)
select page_id, payload_bytes, payload_digest, case when rep <> page_id then 'revisit' else 'response' end as record_type,
  case when rep <> page_id then rep end as refers_to
from m
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op4_mixing": op4_mixing,
    "op6_url_reputation": op6_url_reputation,
    "op10_warc": op10_warc,
}
ORACLES: dict[str, str] = {"op4_mixing": OP4_SQL, "op6_url_reputation": OP6_SQL, "op10_warc": OP10_SQL}


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    count = lambda kind: F.expr(f"cast(size(filter(base, s -> s.kind = {pii.KINDS.index(kind)})) as long)").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.BASE], F.sha2(F.expr(pii.spans_text("base")), 256).alias("base_sha256"), F.expr(pii.spans_text("spans")).alias("spans"), F.expr(f"cast(size(filter(spans, s -> s.kind = {pii.KINDS.index('secret')})) as long)").alias("n_secret"), F.size("spans").cast("long").alias("n_spans"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES |= {"op1_pii": op1_pii, "op7_bpe": op7_bpe}


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    out = toxicity.score(docs, model)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", F.expr("cast(score >= 0.5 as int)").alias("predicted"), F.size("passages").alias("n_passages"))


QUERIES["op3_toxicity"] = op3_toxicity


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All levels; of the longest one the SQL has whether it is at least a window."""
    out = substring.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), F.least("longest", F.lit(substring.WINDOW)).alias("longest"))


OP8_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents),
  g as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') win from w, lateral (select unnest(generate_series(1, len(ws) - 12)) i)),
  m as (select win, min(doc_id) least from g group by win),
  x as (select distinct g.doc_id, g.i + o.o p from g join m on g.win = m.win and g.doc_id > m.least, generate_series(0, 12) o(o)),
  t as (select w.doc_id, p, word from w, lateral (select unnest(generate_series(1, len(ws))) p, unnest(ws) word)),
  k as (select t.doc_id, count(x.p) n_removed, string_agg(case when x.p is null then t.word end, ' ' order by t.p) kept
        from t left join x on t.doc_id = x.doc_id and t.p = x.p group by t.doc_id)
select w.doc_id, len(ws) as n_words, coalesce(k.n_removed, 0) as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256,
  case when k.n_removed > 0 then 13 else 0 end as longest
from w left join k on w.doc_id = k.doc_id
"""

QUERIES["op8_substring_dedup"] = op8_substring_dedup
ORACLES["op8_substring_dedup"] = OP8_SQL


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


QUERIES["op9_jaccard"] = op9_jaccard


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


OP2_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) e from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  s as (select q.vec_id query_id, x.vec_id, list_dot_product(q.e, x.e)::bigint score from v q join v x on q.vec_id % 20 = 0 and q.vec_id <> x.vec_id),
  r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
with recursive v as (select vec_id, embedding::double[] e, label from embeddings where label is not null and embedding is not null
           and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
  l as (select a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.98),
  reach(id, to_id) as (select vec_id, vec_id from embeddings union select reach.id, l.b from reach join l on reach.to_id = l.a),
  c as (select id, min(to_id) component_id from reach group by id),
  n as (select a, count(*) n from l group by a)
select c.id as vec_id, coalesce(n.n, 0) as n_links, component_id, c.id = component_id as kept from c left join n on c.id = n.a
"""

OP9_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws from documents),
  s as (select distinct doc_id, array_to_string(ws[i:i + 4], ' ') sh from w, lateral (select unnest(generate_series(1, greatest(len(ws) - 4, 1))) i) where len(ws) > 0),
  n as (select doc_id, count(*) n from s group by doc_id),
  p as (select a.doc_id a, b.doc_id b, count(*) i from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by 1, 2),
  l as (select a, b from p join n x on a = x.doc_id join n y on b = y.doc_id where 100 * i >= 75 * (x.n + y.n - i)),
  reach(id, to_id) as (select doc_id, doc_id from documents union select reach.id, l.b from reach join l on reach.to_id = l.a),
  c as (select id, min(to_id) component_id from reach group by id)
select c.id as doc_id, coalesce(n.n, 0) as n_shingles, component_id from c left join n on c.id = n.doc_id
"""

QUERIES |= {"op2_topk": op2_topk, "op5_vector_dedup": op5_vector_dedup}
ORACLES |= {"op2_topk": OP2_SQL, "op5_vector_dedup": OP5_SQL, "op9_jaccard": OP9_SQL}
