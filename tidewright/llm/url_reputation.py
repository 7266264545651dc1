"""URL filters: rules by host and path, and empirical-Bayes host reputation.

Labelled page outcomes are counted by host. Beta-binomial priors are fitted by
moments between suffixes, between the registered domains of suffixes and
between the hosts of domains; each level's posterior mean is the mean of the
prior one level below. A host is blocked when the lower bound of its posterior
rate of bad pages lies over a limit. A url that a rule fits gets the rule's
verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, stored

#: The rules of the query, (verdict, host and path).
RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)
#: A host is blocked when its posterior rate of bad pages exceeds LIMIT, Z deviations below its mean.
LIMIT, Z = 0.5, 1.645
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Second labels that belong to the suffix when a two-letter label follows.
SECOND = ("ac", "co", "com", "edu", "gov", "net", "org")

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_parts(url):
    """(host, path) columns of a url column; both empty where it is null or has no ://."""
    host = F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_sql(rules=RULES, of: int = 1) -> str:
    """A CASE over host and path: the longest rule that fits (of=1) or its verdict (of=0)."""
    q = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "''") + "'"
    arms = []
    for rule in sorted(rules, key=lambda r: -len(r[1])):
        host, slash, path = rule[1].partition("/")
        arms.append(f"when (host = {q(host)} or right(host, {len(host) + 1}) = {q('.' + host)}) and left(path, {len(slash + path)}) = {q(slash + path)} then {q(rule[of])}")
    return f"case {' '.join(arms)} end" if arms else "cast(null as string)"


#: SQL shared with the oracle: levels, posteriors and the bound.
DOMAIN = """case when host = '' then '' when not host like '%.%' then host
  when length(regexp_extract(host, '([^.]*)$', 1)) = 2 and regexp_extract(host, '([^.]*)[.][^.]*$', 1) in ({second}) and host like '%.%.%'
  then regexp_extract(host, '([^.]*[.][^.]*[.][^.]*)$', 1)
  else regexp_extract(host, '([^.]*[.][^.]*)$', 1) end""".format(second=", ".join(f"'{x}'" for x in SECOND))
SUFFIX = "case when domain like '%.%' then regexp_extract(domain, '^[^.]*[.](.*)$', 1) else domain end"


def _strength(unit: str, above: str) -> str:
    """Prior strength (alpha + beta) from the spread of units around the mean of
    what is above them: E n (p - r)^2 = r (1 - r) (1 - n / N) (1 + (n - 1) rho), strength 1 / rho - 1."""
    return f"""select round(greatest(0.5, least(1000.0, 1.0 / greatest(coalesce(rho, 1.0), 0.0005) - 1.0)), 6) k from (
      select (sum(u.n * (u.bad / u.n - a.rate) * (u.bad / u.n - a.rate)) - sum(a.rate * (1 - a.rate) * (1 - u.n / a.n)))
        / nullif(sum(a.rate * (1 - a.rate) * (1 - u.n / a.n) * (u.n - 1)), 0) rho
      from {unit} u join (select *, (bad + 0.5) / (n + 1.0) rate from {above}) a on u.up = a.unit where u.n > 0 and a.n > 0) q"""


#: Counts of labelled pages and of bad ones by host, hosts without labels included.
COUNTS = """select p.host, cast(count(o.bad) as double) n, cast(coalesce(sum(o.bad), 0) as double) bad
    from {pages} p left join {outcomes} o on p.page_id = o.page_id group by p.host"""
REPUTATION = f"""
with hosts1 as (select *, {DOMAIN} as domain from {{counts}}),
  hosts as (select host as unit, domain as up, {SUFFIX} as suffix, n, bad from hosts1),
  domains as (select up as unit, min(suffix) as up, sum(n) n, sum(bad) bad from hosts group by up),
  suffixes as (select up as unit, '*' as up, sum(n) n, sum(bad) bad from domains group by up),
  world as (select '*' as unit, sum(n) n, sum(bad) bad from suffixes),
  k as (select (select k from ({_strength('suffixes', 'world')}) k1) ks, (select k from ({_strength('domains', 'suffixes')}) k2) kd, (select k from ({_strength('hosts', 'domains')}) k3) kh),
  s as (select x.unit, (x.bad + ks * (w.bad + 0.5) / (w.n + 1.0)) / (x.n + ks) m from suffixes x cross join world w cross join k),
  d as (select x.unit, (x.bad + kd * s.m) / (x.n + kd) m from domains x join s on x.up = s.unit cross join k),
  h as (select x.unit as host, x.n, x.bad, (x.bad + kh * d.m) / (x.n + kh) m, x.n + kh as strength from hosts x join d on x.up = d.unit cross join k)
select host as r_host, round(m, 9) as rate, round(greatest(0.0, m - {Z} * sqrt(m * (1 - m) / (strength + 1))), 9) as low from h
"""


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(r_host, rate, low): posterior mean and lower bound for each host of
    pages (page_id, host). outcomes: (page_id, bad 0 or 1); rows with nulls
    count for nothing, and a page labelled twice counts twice."""
    spark = pages.sparkSession
    counts = stored(spark.sql(COUNTS, pages=pages, outcomes=outcomes), "hosts")
    return spark.sql(REPUTATION, counts=counts)


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, limit: float = LIMIT) -> DataFrame:
    """(page_id, host, path, rule, verdict, rate, low) for every row of pages
    (page_id, url). A null or shapeless url has an empty host, which is judged
    as a host of its own. Repeated rows give repeated results; other columns
    of pages are not read."""
    host, path = url_parts(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    good = outcomes.select("page_id", F.col("bad").cast("int").alias("bad")).where("page_id is not null and bad is not null")
    rep = host_reputation(p.select("page_id", "host"), good)
    n_hosts = p.select(F.approx_count_distinct("host")).first()[0]
    out = p.join(small(rep, n_hosts), F.expr("host = r_host"), "left")
    rule, verdict = F.expr(rule_sql(rules, 1)), F.expr(rule_sql(rules, 0))
    return out.select(
        "page_id", "host", "path", rule.cast("string").alias("rule"),
        F.coalesce(verdict, F.when(F.col("low") > limit, "block").otherwise("allow")).alias("verdict"), "rate", "low",
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """(page_id, bad) from labels (doc_id, quality, toxic): a page is bad when it is toxic or of low quality."""
    return labels.select(F.col("doc_id").alias("page_id"), F.expr("cast(toxic = 1 or quality = 0 as int)").alias("bad")).where("bad is not null")
