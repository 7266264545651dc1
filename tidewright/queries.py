"""Named queries over the driver's tables and their SQL. Events play the diary's
log, documents and pages the sources, embeddings the points."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import diary as D
from .functions import tags as G
from .functions import text as X
from .functions.vectors import valid_vector
from .operators import graph, lifecycle, points, split, status

BUDGET = 512
NOW = 1706745600.0  # 2024-02-01
LEASE = 1800.0
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
KEYS = ["agent_id", "scope", "source"]


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# shared relations

SPECS = [
    ("parsing_chunking", "Parsing and chunking", 0, "chunker", []),
    ("embedding", "Computing embeddings", 1, "embedder", ["parsing_chunking"]),
    ("cards", "Catalogue cards", 2, None, ["embedding"]),
    ("graph", "Knowledge graph", 3, "graph", ["parsing_chunking", "embedding"]),
]
STATES = {"purchase": "complete", "click": "skipped", "error": "error", "view": "processing", "signup": "pending"}
_cases = " ".join(f"when '{k}' then '{v}'" for k, v in STATES.items())
EV = f"""ev as (select user_id, event_id, ts, event_type, props, case when event_id % 2 = 0 then 'parsing_chunking' else 'embedding' end as phase,
  case event_type {_cases} end as st from events)"""
DIARY = f"""{EV}, last as (select *, row_number() over (partition by user_id, phase order by ts desc, event_id desc) rn, min((epoch_us(ts), event_id)) over (partition by user_id, phase) as first_seq from ev),
  diary as (select * from last where rn = 1 and st <> 'pending')"""
SPECS_SQL = "specs(id, pos) as (values ('parsing_chunking', 0), ('embedding', 1), ('cards', 2), ('graph', 3)), edges(id, dep, dep_pos) as (values ('embedding', 'parsing_chunking', 0), ('cards', 'embedding', 0), ('graph', 'parsing_chunking', 0), ('graph', 'embedding', 1))"


def specs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*s, None) for s in SPECS], "id string, label string, pos int, settings_category string, depends_on array<string>, settings_check array<string>")


def edges(spark: SparkSession) -> DataFrame:
    return specs(spark).select("id", F.explode("depends_on").alias("dep"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log of diaries: the owner's class is user_id % 4, the tag's version event_id % 3."""
    e = table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp").cast("double")
    kind = F.create_map(*[F.lit(x) for kv in STATES.items() for x in kv])[F.col("event_type")]
    phase = F.when(F.col("event_id") % 2 == 0, "parsing_chunking").otherwise("embedding")
    owner = (
        F.when(F.col("user_id") % 4 == 1, F.struct(F.lit("here").alias("pod"), F.lit(1).alias("pid"), F.lit("now").alias("boot")))
        .when(F.col("user_id") % 4 == 2, F.struct(F.lit("here").alias("pod"), F.col("user_id").cast("int").alias("pid"), F.lit("before").alias("boot")))
        .when(F.col("user_id") % 4 == 3, F.struct(F.lit("there").alias("pod"), F.lit(1).alias("pid"), F.lit("before").alias("boot")))
    )
    none = F.lit(None).cast("string")
    entry = F.struct(
        kind.alias("state"), F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("reason"), at.alias("started_at"), owner.alias("owner"),
        F.concat(phase, F.lit("@"), (F.col("event_id") % 3).cast("string")).alias("tag"), F.lit(0).alias("attempt"), none.alias("marker"), F.lit(False).alias("marker_known"), none.alias("settings_version"),
        F.lit(None).cast("map<string,string>").alias("deps"), F.array(F.struct(F.get_json_object("props", "$.k").alias("code"), F.col("event_type").alias("message"))).alias("warnings"),
    )
    return e.select(
        F.lit("a").alias("agent_id"), F.lit("agent").alias("scope"), F.col("user_id").cast("string").alias("source"), phase.alias("phase"),
        F.struct("ts", "event_id").alias("seq"), (kind == "pending").alias("removed"), entry.alias("entry"),
    )


def diary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.fold_diary(events(spark, sf_dir))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.lit("a").alias("agent_id"), F.lit("agent").alias("scope"), F.col("user_id").cast("string").alias("source")).distinct()


SRC = "cast(user_id as varchar) as source"


# text and splitting


@query(f"""select source, count(*) as n_docs, count(*) filter (greatest(1, length(text) // 3) > {BUDGET}) as n_oversized, max(greatest(1, length(text) // 3)) as max_tok
from documents group by source""")
def q01_token_budget(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", X.token_estimate(F.col("text")).alias("tok"))
    return d.groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if(F.col("tok") > BUDGET).alias("n_oversized"), F.max("tok").alias("max_tok"))


@query(r"""select doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\s\x0b\x0c\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda w: w <> '')) as n_words from documents""")
def q02_word_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.word_count(F.col("text")).alias("n_words"))


@query(f"select doc_id, case when greatest(1, length(text) // 3) > {BUDGET} then 'split' else 'whole' end as branch, greatest(1, length(text) // 3) as tok from documents")
def q03_within_budget(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", X.token_estimate(F.col("text")).alias("tok"))
    return d.select("doc_id", F.when(F.col("tok") > BUDGET, "split").otherwise("whole").alias("branch"), "tok")


@query(rf"""with recursive w as (select doc_id, coalesce(text, '') text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\s\x0b\x0c\x1c-\x1f\x85\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+'), lambda x: x <> '') ws from documents),
  u as (select doc_id, unnest(ws) word, generate_subscripts(ws, 1) p from w where greatest(1, length(text) // 3) > {BUDGET}),
  s as (select doc_id, p, sum(length(word)) over (partition by doc_id order by p) c from u),
  d as (select doc_id, list_concat([0], list(c::bigint order by p)) c, count(*) n from s group by doc_id),
  b as (select *, greatest(1, trunc({BUDGET}::double * least(n, 200) / greatest(1, (c[least(n, 200) + 1] + least(n, 200) - 1) // 3)))::bigint wide from d),
  step(doc_id, a, e) as (
    select doc_id, 0::bigint, coalesce(list_max(list_filter(range(1, least(wide, n) + 1), lambda x: c[x + 1] + x - 1 <= 3 * {BUDGET} + 2)), 1) from b
    union all
    select b.doc_id, step.e, coalesce(list_max(list_filter(range(step.e + 1, least(step.e + wide, n) + 1), lambda x: c[x + 1] - c[step.e + 1] + x - step.e - 1 <= 3 * {BUDGET} + 2)), step.e + 1) from step join b using (doc_id) where step.e < n),
  k as (select doc_id, count(*) n_chunks, max(greatest(1, (c[e + 1] - c[a + 1] + e - a - 1) // 3)) max_tok from step join b using (doc_id) group by doc_id)
select w.doc_id, coalesce(n_chunks, 1) as n_chunks, coalesce(max_tok, greatest(1, length(text) // 3)) as max_tok, len(ws) as n_words from w left join k using (doc_id)""")
def q04_split_chunks(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    chunks = split.split_oversized(d, BUDGET)
    return chunks.groupBy("doc_id").agg(F.count("*").alias("n_chunks"), F.max(X.token_estimate(F.col("page_content"))).alias("max_tok"), F.sum(X.word_count(F.col("page_content"))).alias("n_words"))


# points

PTS = """pts as (select vec_id, label, case when vec_id % 11 = 0 then null when vec_id % 7 = 0 then list_transform(embedding, lambda x: 0::float) else embedding end v, vec_id % 5 = 0 as flag from embeddings),
  ok as (select *, coalesce(len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and sqrt(list_sum(list_transform(v, lambda x: x::double * x::double))) > 1e-12, false) valid from pts)"""


def pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the store: some without a vector, some all zero, some flagged as cards, some of these under the card's id."""
    e = table(spark, sf_dir, "embeddings")
    v = F.when(F.col("vec_id") % 11 == 0, None).when(F.col("vec_id") % 7 == 0, F.transform("embedding", lambda x: F.lit(0.0).cast("float"))).otherwise(F.col("embedding"))
    source = F.concat(F.lit("s"), F.col("label").cast("string"))
    card = X.catalogue_card_id(F.lit("a"), F.lit(None).cast("string"), source, F.col("vec_id").cast("int"))
    return e.select(
        F.lit("a").alias("agent_id"), F.lit("declarative").alias("collection"), F.when(F.col("vec_id") % 10 == 0, card).otherwise(F.concat(F.lit("p"), F.col("vec_id").cast("string"))).alias("point_id"), F.lit(None).cast("string").alias("payload_id"),
        source.alias("source"), F.lit(None).cast("string").alias("chat_id"), (F.col("vec_id") % 5 == 0).alias("is_catalogue_card"), F.col("vec_id").cast("int").alias("chunk_index"), F.lit(None).cast("int").alias("start_index"), v.alias("vector"), "vec_id", "label",
    )


@query(f"with {PTS} select label, count(*) as n_points, count(*) filter (valid) as n_valid, count(*) filter (v is null) as n_empty from ok group by label")
def q05_vector_validity(spark, sf_dir):
    return pts(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n_points"), F.count_if(valid_vector(F.col("vector"))).alias("n_valid"), F.count_if(F.col("vector").isNull()).alias("n_empty"))


# diaries


@query(f"with {DIARY} select {SRC}, phase, st as state, event_id from diary")
def q06_latest_entry(spark, sf_dir):
    return diary(spark, sf_dir).select("source", "phase", D.phase_state(F.col("entry")).alias("state"), F.expr("cast(substring(entry.reason, 7) as long)").alias("event_id"))


DERIVED = f"""{DIARY}, users as (select distinct user_id from events),
  derived as (select u.user_id, case when coalesce(bool_or(d.st = 'error'), false) then 'error' when bool_or(coalesce(d.st, 'pending') in ('pending', 'processing')) then 'processing' else 'complete' end as derived
    from users u cross join (values ('parsing_chunking'), ('embedding')) p(phase) left join diary d on d.user_id = u.user_id and d.phase = p.phase group by u.user_id)"""


def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    phases = sources(spark, sf_dir).withColumn("phase", F.explode(F.array(F.lit("parsing_chunking"), F.lit("embedding"))))
    return status.derive_status(diary(spark, sf_dir), phases)


@query(f"with {DERIVED} select {SRC}, derived from derived")
def q07_derived_status(spark, sf_dir):
    return derived(spark, sf_dir).select("source", "derived")


@query(f"with {DERIVED} select derived, count(*) as n_sources from derived group by derived")
def q08_status_counts(spark, sf_dir):
    return derived(spark, sf_dir).groupBy("derived").agg(F.count("*").alias("n_sources"))


@query(f"with {DIARY} select phase, json_extract_string(props, '$.k') as code, event_type as message, count(*) as n from diary where st = 'complete' and json_extract_string(props, '$.k') is not null group by all")
def q09_warnings(spark, sf_dir):
    return status.warnings_of(diary(spark, sf_dir)).groupBy("phase", "code", "message").agg(F.count("*").alias("n"))


@query(f"""with {DERIVED}, r as (select d.user_id, case when d.derived = 'complete' then 'completed' else d.derived end status, case when d.derived = 'processing' then 'embedding' when d.user_id % 3 = 0 then 'unknown' end phase from derived d)
select {SRC}, status, phase, case status when 'completed' then 'Completed' when 'processing' then 'Processing' else 'Error' end as status_label,
  case when phase = 'embedding' then 'Computing embeddings' when phase is not null then case status when 'completed' then 'Completed' when 'processing' then 'Processing' else 'Error' end end as phase_label from r""")
def q10_status_report(spark, sf_dir):
    d = derived(spark, sf_dir)
    rows = d.select("source", F.when(F.col("derived") == "complete", "completed").otherwise(F.col("derived")).alias("status"), F.when(F.col("derived") == "processing", "embedding").when(F.col("source").cast("long") % 3 == 0, "unknown").alias("phase"))
    return status.status_report(rows, specs(spark)).select("source", "status", "phase", "status_label", "phase_label")


@query(f"with {DIARY} select {SRC}, arg_min('event ' || event_id, first_seq) as reason from diary where st = 'error' group by user_id")
def q11_first_error(spark, sf_dir):
    return status.first_error(diary(spark, sf_dir)).select("source", "reason")


@query("""with l as (select user_id, case when event_id % 2 = 0 then 'parsing_chunking' else 'embedding' end phase, lag(event_id % 7) over (partition by user_id, event_id % 2 order by event_id) before from events)
select cast(user_id as varchar) as source, phase, max(coalesce(before, 0) + 1)::int as attempt from l group by user_id, phase""")
def q12_attempts(spark, sf_dir):
    """The highest attempt that the entry after each of a log would have."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("source"), F.when(F.col("event_id") % 2 == 0, "parsing_chunking").otherwise("embedding").alias("phase"), "event_id", F.struct((F.col("event_id") % 7).cast("int").alias("attempt")).alias("e"))
    before = F.lag("e").over(Window.partitionBy("source", "phase").orderBy("event_id"))
    return e.withColumn("before", before).groupBy("source", "phase").agg(F.max(D.next_attempt(F.col("before"))).alias("attempt"))


# keys, tags and the graph


@query("select page_id, 'agents:a:ingestion:agent:' || sha256(url) as status_key from pages")
def q13_status_keys(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", X.status_key(F.lit("a"), F.lit("agent"), F.col("url")).alias("status_key"))


@query("""with own as (select doc_id, sha256('parsing_chunking:{"lang":"' || lang || '"}') p, sha256('embedding:{"source":"' || source || '"}') e from documents),
  t as (select doc_id, sha256(p || '|') parse_tag, e from own)
select doc_id, parse_tag, sha256(e || '|parsing_chunking=' || parse_tag) as embed_tag from t""")
def q14_tags(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    none = F.array().cast("array<string>")
    no_tags = F.create_map().cast("map<string,string>")
    own = lambda kind, key: G.own_tag_column(F.lit(kind), F.concat(F.lit('{"' + key + '":"'), F.col(key), F.lit('"}')))
    parse = d.select("doc_id", G.compose_tag_column(own("parsing_chunking", "lang"), none, no_tags).alias("parse_tag"), own("embedding", "source").alias("own"))
    return parse.select("doc_id", "parse_tag", G.compose_tag_column(F.col("own"), F.array(F.lit("parsing_chunking")), F.create_map(F.lit("parsing_chunking"), F.col("parse_tag"))).alias("embed_tag"))


@query(f"with recursive {SPECS_SQL}, down(id) as (select id from edges where dep = 'parsing_chunking' union select e.id from down join edges e on e.dep = down.id) select id as phase from down")
def q15_downstream(spark, sf_dir):
    return graph.downstream(edges(spark), "parsing_chunking").select(F.col("id").alias("phase"))


@query(f"""with recursive {SPECS_SQL}, walk(id, depth) as (select id, 0 from specs union all select e.id, w.depth + 1 from walk w join edges e on e.dep = w.id)
select s.id as phase, max(depth)::int as depth, row_number() over (order by max(depth), s.pos)::int as step from specs s join walk using (id) group by s.id, s.pos""")
def q16_execution_order(spark, sf_dir):
    d = graph.depths(specs(spark))
    return d.select(F.col("id").alias("phase"), F.col("depth").cast("int").alias("depth"), F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("depth", "pos")).alias("step"))  # the graph's few rows


@query(f"with {DIARY}, {SPECS_SQL} select u.source, s.id as phase from (select distinct {SRC}, user_id from events) u cross join specs s left join diary d on d.user_id = u.user_id and d.phase = s.id where d.user_id is null")
def q17_absent_phases(spark, sf_dir):
    grid = sources(spark, sf_dir).join(F.broadcast(specs(spark).select(F.col("id").alias("phase"))))
    return grid.join(diary(spark, sf_dir).select(*KEYS, "phase"), [*KEYS, "phase"], "left_anti").select("source", "phase")


#: Abandoned at NOW, seen from pod here in boot now, where pids that three divides live.
ABANDON = f"""(st = 'processing' and case user_id % 4 when 0 then {NOW} - epoch(ts) > {LEASE} when 1 then false when 2 then user_id % 3 <> 0 else {NOW} - epoch(ts) > {LEASE} end)"""
STALE = f"""{DIARY}, {SPECS_SQL}, users as (select distinct user_id from events),
  blocked as (select u.user_id, e.id phase, bool_or(d.st is null or d.st <> 'complete') blocked from users u cross join edges e left join diary d on d.user_id = u.user_id and d.phase = e.dep group by 1, 2),
  pending as (select u.user_id, s.id phase, s.pos from users u cross join specs s left join diary d on d.user_id = u.user_id and d.phase = s.id left join blocked b on b.user_id = u.user_id and b.phase = s.id
    where case when d.st is null then true when d.st = 'processing' then {ABANDON.replace('user_id', 'd.user_id').replace('ts)', 'd.ts)').replace("st =", "d.st =")} when d.st in ('error', 'skipped') then false
      when coalesce(b.blocked, false) then true else d.event_id % 3 <> 0 end)"""


def abandoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = F.expr("array(cast(if(cast(source as long) % 3 = 0, source, '-1') as int))")
    return diary(spark, sf_dir).where(D.should_abandon(F.col("entry"), F.lit(NOW), F.lit("here"), F.lit("now"), live, LEASE))


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = spark.createDataFrame([(s[0], s[0] + "@0") for s in SPECS], "phase string, current_tag string")
    return graph.pending(sources(spark, sf_dir), specs(spark), diary(spark, sf_dir), tags, abandoned(spark, sf_dir))


@query(f"with {STALE} select {SRC}, phase from pending")
def q18_stale_phases(spark, sf_dir):
    return pending(spark, sf_dir).select("source", "phase")


OFFENDER = f"""select u.user_id, e.id phase, arg_min(d.st, e.dep_pos) state, arg_min('dependency ' || e.dep || ' is ' || d.st, e.dep_pos) reason
    from users u cross join edges e join {{d}} d on d.user_id = u.user_id and d.phase = e.dep left join {{d}} o on o.user_id = u.user_id and o.phase = e.id
    where o.user_id is null and d.st in ('error', 'skipped') group by 1, 2"""


@query(f"with {STALE}, f as ({OFFENDER.format(d='diary')}) select {SRC}, phase, state, reason from f")
def q19_first_offender(spark, sf_dir):
    return graph.first_offender(sources(spark, sf_dir), specs(spark), diary(spark, sf_dir)).select("source", "phase", "state", "reason")


_passes = [f"d{i} as (select user_id, phase, st, reason from d{i - 1} union all select * from ({OFFENDER.format(d=f'd{i - 1}')}))" for i in range(1, 5)]


@query(f"with {STALE}, d0 as (select user_id, phase, st, 'event ' || event_id as reason from diary), {', '.join(_passes)} select {SRC}, phase, st as state, reason from d4")
def q20_propagated(spark, sf_dir):
    d = diary(spark, sf_dir).select(*KEYS, "phase", F.struct(F.col("entry.state").alias("state"), F.col("entry.reason").alias("reason")).alias("entry"))
    return graph.propagate(sources(spark, sf_dir), specs(spark), d).select("source", "phase", F.col("entry.state").alias("state"), F.col("entry.reason").alias("reason"))


# lifecycle


@query(f"with {DIARY} select {SRC}, phase from diary where {ABANDON}")
def q21_abandoned(spark, sf_dir):
    return abandoned(spark, sf_dir).select("source", "phase")


ROWS = """rows as (select doc_id, 'f' || doc_id source, case doc_id % 8 when 0 then 'uploaded' when 1 then 'downloading' when 2 then 'downloaded' when 3 then 'processing' when 4 then 'reindexing' when 5 then 'deleting' when 6 then 'completed' else 'error' end status,
  {now} - (doc_id % 700)::double updated_at, doc_id % 9 = 0 resume_created, case when doc_id % 4 = 0 then (doc_id % 200)::varchar else 'agent' end "scope", case when doc_id % 3 = 0 then 'url' else 'file' end type from documents)""".format(now=NOW)


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status row for each document."""
    states = F.array(*[F.lit(s) for s in ("uploaded", "downloading", "downloaded", "processing", "reindexing", "deleting", "completed", "error")])
    i = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.lit("a").alias("agent_id"), F.when(i % 4 == 0, (i % 200).cast("string")).otherwise("agent").alias("scope"), F.concat(F.lit("f"), i.cast("string")).alias("source"),
        F.element_at(states, (i % 8 + 1).cast("int")).alias("status"), (F.lit(NOW) - (i % 700).cast("double")).alias("updated_at"), (i % 9 == 0).alias("resume_created"), F.when(i % 3 == 0, "url").otherwise("file").alias("type"), "doc_id",
    )


@query(f"""with {ROWS} select source, case when resume_created and status in ('uploaded', 'downloading', 'downloaded', 'processing') and {NOW} - updated_at < 120 then false when status = 'completed' then false
  when status in ('uploaded', 'downloading', 'downloaded', 'processing', 'error') then {NOW} - updated_at >= 120 else false end as claimable from rows""")
def q22_claimable(spark, sf_dir):
    return rows(spark, sf_dir).select("source", lifecycle.claimable(F.col("status"), F.col("updated_at"), F.col("resume_created"), F.lit(NOW), 120.0).alias("claimable"))


def pending_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that have something to do: those that the labels call bad."""
    bad = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id")
    return rows(spark, sf_dir).join(bad, "doc_id", "left_semi")


@query(f"""with {ROWS} select source, status from rows r where (status in ('downloading', 'downloaded') and {NOW} - updated_at >= 300) or (status in ('uploaded', 'processing') and {NOW} - updated_at >= 60)
  or (status = 'error' and {NOW} - updated_at >= 60 and exists (select 1 from labels l where l.doc_id = r.doc_id and l.quality = 0))""")
def q23_resume_candidates(spark, sf_dir):
    return lifecycle.resume_candidates(rows(spark, sf_dir), pending_rows(spark, sf_dir), NOW).select("source", "status")


@query(f"with {ROWS} select source from rows r where status = 'completed' and exists (select 1 from labels l where l.doc_id = r.doc_id and l.quality = 0)")
def q24_completed_stale(spark, sf_dir):
    return lifecycle.completed_but_stale(rows(spark, sf_dir), pending_rows(spark, sf_dir)).select("source")


#: What still exists: files of labelled documents, pages of the first half, chats of conversations.
GONE = """r as (select * from rows where status not in ('uploaded', 'downloading', 'downloaded', 'processing', 'error')),
  gone as (select r.source, r.scope from r where (scope <> 'agent' and not exists (select 1 from conversations c where c.conv_id::varchar = r.scope))
    or (type = 'file' and not exists (select 1 from labels l where l.doc_id = r.doc_id))
    or (type = 'url' and not exists (select 1 from pages p where p.page_id * 2 = r.doc_id)))"""


@query(f'with {ROWS}, {GONE} select source, "scope" from gone')
def q25_reconcile(spark, sf_dir):
    chats = table(spark, sf_dir, "conversations").select(F.lit("a").alias("agent_id"), F.col("conv_id").cast("string").alias("chat_id")).distinct()
    every = rows(spark, sf_dir)
    files = every.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select("agent_id", "scope", F.col("source").alias("name"))
    web = every.join(table(spark, sf_dir, "pages").select((F.col("page_id") * 2).alias("doc_id")), "doc_id", "left_semi").select("agent_id", X.collection_for(F.col("scope")).alias("collection"), "source")
    return lifecycle.reconcile(every, chats, files, web).select("source", "scope")


@query("select distinct url as source from pages p where not exists (select 1 from pages q where q.url = p.url and q.page_id % 2 = 0)")
def q26_reconcile_urls(spark, sf_dir):
    p = table(spark, sf_dir, "pages").withColumns({"agent_id": F.lit("a"), "scope": F.lit("agent"), "source": F.col("url"), "status": F.lit("completed"), "type": F.lit("url")})
    chats = spark.createDataFrame([], "agent_id string, chat_id string")
    files = spark.createDataFrame([], "agent_id string, scope string, name string")
    return lifecycle.reconcile(p, chats, files, p.where("page_id % 2 = 0").withColumn("collection", F.lit("declarative"))).select("source")


@query(f"""with {ROWS} select source, "scope" from rows r where "scope" <> 'agent' and not exists (select 1 from conversations c where c.conv_id::varchar = r."scope")""")
def q27_orphan_chats(spark, sf_dir):
    chats = table(spark, sf_dir, "conversations").select(F.lit("a").alias("agent_id"), F.col("conv_id").cast("string").alias("chat_id"))
    return lifecycle.orphans(rows(spark, sf_dir), chats).select("source", "scope")


@query(f"""with {DIARY}, {SPECS_SQL}, d as (select user_id, phase, pos, {ABANDON} gone from diary join specs on id = phase), s as (select *, min(pos) filter (gone) over (partition by user_id) first from d)
select {SRC}, phase, row_number() over (partition by user_id order by pos desc)::int as step from s where pos >= first""")
def q28_recovery(spark, sf_dir):
    return lifecycle.recovery_order(diary(spark, sf_dir), abandoned(spark, sf_dir), specs(spark)).select("source", "phase", "step")


@query(f"with {DIARY} select {SRC}, phase from diary where phase not in ('parsing_chunking', 'cards')")
def q29_uninstalled(spark, sf_dir):
    return graph.uninstalled(diary(spark, sf_dir), specs(spark).where("id in ('parsing_chunking', 'cards')")).select("source", "phase")


@query(f"with {PTS} select vec_id from ok where valid and not (vec_id % 10 = 0)")
def q30_purge_preview(spark, sf_dir):
    return points.purge_embedding(pts(spark, sf_dir)).select("vec_id")


@query("""select 'p' || page_id as id, case when url like 'http%' then 'url' else 'file' end as type, 'agent' as "scope", 'declarative' as collection from pages
union all select 'd' || doc_id, case when source like 'http%' then 'url' else 'file' end, case when doc_id % 4 = 0 then lang else 'agent' end, case when doc_id % 4 = 0 then 'episodic' else 'declarative' end from documents""")
def q31_source_types(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"), F.col("url").alias("s"), F.lit(None).cast("string").alias("chat"))
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("source").alias("s"), F.when(F.col("doc_id") % 4 == 0, F.col("lang")).alias("chat"))
    scope = X.scope_of(F.col("chat"))
    return p.unionByName(d).select("id", X.source_type(F.col("s")).alias("type"), scope.alias("scope"), X.collection_for(scope).alias("collection"))


@query(f"with {PTS} select 's' || (vec_id % 50) as source, count(*) as intended, count(*) filter (valid) as valid, case when count(*) filter (valid) = 0 then 'error' else 'done' end as outcome from ok group by vec_id % 50")
def q32_embedding_gate(spark, sf_dir):
    p = pts(spark, sf_dir).withColumn("source", F.concat(F.lit("s"), (F.col("vec_id") % 50).cast("string")))
    return points.embedding_gate(p, ["source"])


@query(f"""with {ROWS} select source, status not in ('uploaded', 'downloading', 'downloaded', 'processing') as deleted, case when status in ('uploaded', 'downloading', 'downloaded', 'processing') then 'in_flight' end as reason from rows
union all select 'nothing', false, 'not_found'""")
def q33_delete_answers(spark, sf_dir):
    every = rows(spark, sf_dir)
    asked = every.select(*KEYS).unionByName(spark.createDataFrame([("a", None, "nothing")], "agent_id string, scope string, source string"))
    return lifecycle.delete_answer(asked, every).select("source", "deleted", "reason")


@query(f"with {PTS} select 's' || label as source, count(*) as chunks from ok where vec_id % 10 <> 0 group by label")
def q34_stored_sources(spark, sf_dir):
    return points.stored_sources(pts(spark, sf_dir)).select("source", "chunks")


STATUS_OF = {"purchase": "completed", "click": "processing", "error": "error", "view": "processing"}


@query("""with e as (select user_id, event_id i, epoch(ts) t, event_type y, case event_type when 'purchase' then 'completed' when 'click' then 'processing' when 'error' then 'error' when 'view' then 'processing' end st from events),
  x as (select user_id, string_agg(y || '=' || v, ';' order by y) extra from (select user_id, y, max(i) v from e where i % 3 = 0 group by 1, 2) group by 1),
  f as (select user_id, arg_max(st, i) filter (st is not null) status, arg_max({'e': case when y = 'error' then 'err ' || i end}, i) filter (st is not null) er, arg_max(t, i) filter (st = 'error') error_at, min(t) created_at, max(t) updated_at,
    arg_max('p' || i % 4, i) filter (y = 'view') phase, max(i) filter (y = 'view') set_at, max(i) filter (y = 'purchase') cleared_at, arg_max('m' || i % 5, i) filter (y = 'click') embedder_name, arg_max(i % 2 = 0, i) filter (y = 'signup') rc from e group by user_id)
select cast(user_id as varchar) as source, status, er.e as error, error_at, created_at, updated_at, case when coalesce(cleared_at >= set_at, false) then null else phase end as phase, embedder_name, case when status in ('completed', 'error') then null else rc end as resume_created, extra
from f left join x using (user_id)""")
def q35_status_fold(spark, sf_dir):
    t, i = F.col("event_type"), F.col("event_id")
    none = lambda kind="string": F.lit(None).cast(kind)
    text = lambda head, c: F.concat(F.lit(head), c.cast("string"))
    log = table(spark, sf_dir, "events").select(
        F.lit("a").alias("agent_id"), F.lit("agent").alias("scope"), F.col("user_id").cast("string").alias("source"), i.alias("seq"), F.col("ts").cast("timestamp").cast("double").alias("ts"), F.lit("file").alias("type"), none().alias("chat_id"),
        F.create_map(*[F.lit(x) for kv in STATUS_OF.items() for x in kv])[t].alias("status"), F.when(t == "error", text("err ", i)).alias("error"), F.when(t == "view", text("p", i % 4)).alias("phase"), (t == "purchase").alias("clear_phase"), F.when(t == "click", text("m", i % 5)).alias("embedder_name"),
        none().alias("chunker_name"), F.when(t == "signup", i % 2 == 0).alias("resume_created"), F.when(i % 3 == 0, F.create_map(t, i.cast("string"))).alias("extra"),
    )
    extra = F.array_join(F.transform(F.array_sort(F.map_entries("extra")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return status.fold_status(log).select("source", "status", "error", "error_at", "created_at", "updated_at", "phase", "embedder_name", "resume_created", extra.alias("extra"))


@query("""select 'a' as agent_id, label, md5(string_agg(vec_id::varchar, ',' order by vec_id)) as cards from embeddings where vec_id % 10 = 0 group by label""")
def q36_cards(spark, sf_dir):
    p = points.with_card(pts(spark, sf_dir)).where("is_card")
    return p.groupBy("agent_id", "label").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list("vec_id")), lambda x: x.cast("string")), ",")).alias("cards"))
