"""Mixing sources to target weights by Poisson replication.

Every document draws a repetition count from a Poisson distribution whose mean
is the repetition rate its source needs to reach its target weight. The draw
inverts the distribution at a uniform number made from a hash of the seed and
the document's id, so it depends on nothing but the document, the seed and the
rates: partitions, retries and lost executors do not change it. The document is
then exploded by its count and all copies are dealt out and ordered by a second
hash, which is a global shuffle. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small

#: Largest mean that is inverted at once; larger means are sums of independent draws.
STEP = 32.0
#: Terms of the distribution function kept for a mean of at most STEP: what lies beyond has a probability below 2 ** -60.
TERMS = 128
#: Parts that a source's rate is copied to when there are too many sources to broadcast.
SALTS = 32


def uniform(text):
    """A number in (0, 1) from 52 bits of SHA-256 of a string column."""
    return (F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: DataFrame | None = None, total: float | None = None, source: str = "source") -> DataFrame:
    """(source, n, rate, draws, cdf) for each source of docs, null included.

    weights: (source, weight), one row a source; null: every source weighs the
    same. A source that has no weight, or one that is null, negative or not
    finite, gets weight 0. total: documents wanted, as many as there are if
    null. The rates are total * weight / sum of weights / documents."""
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighed = counts.withColumn("weight", F.lit(1.0))
    else:
        w = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("double").alias("weight"))
        weighed = counts.join(w, F.expr("source <=> w_source"), "left").drop("w_source")
        weighed = weighed.withColumn("weight", F.expr("if(weight > 0 and not isnan(weight) and weight < double('infinity'), weight, 0D)"))
    all_n, all_weight = weighed.agg(F.sum("n"), F.sum("weight")).first()
    rate = F.lit(float((all_n or 0) if total is None else total)) * F.col("weight") / F.lit(float(all_weight or 0) or 1.0) / F.col("n")
    return (
        weighed.select("source", "n", rate.alias("rate"))
        .withColumn("draws", F.expr(f"greatest(1, cast(ceil(rate / {STEP}D) as int))"))
        .withColumn(
            "cdf",
            F.expr(
                f"""aggregate(sequence(1, {TERMS}),
                     named_struct('p', exp(-rate / draws), 'c', exp(-rate / draws), 'all', array(exp(-rate / draws))),
                     (s, k) -> named_struct('p', s.p * (rate / draws) / k, 'c', s.c + s.p * (rate / draws) / k,
                                            'all', concat(s.all, array(s.c + s.p * (rate / draws) / k))),
                     s -> filter(s.all, (c, i) -> i = 0 or c > s.all[i - 1]))"""
            ),
        )
    )


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, total: float | None = None, seed: str = "mix", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The columns of docs, then copy (int, from 1) and mix_key (string): one
    row for each copy, in the global order of mix_key within its partitions.

    Rows that share an id draw the same count. A null id counts as the text
    "null"; a null source is a source of its own; an empty table stays empty.
    Columns of any names pass through, texts of any length too: where an input
    column is named copy or mix_key, the new one gets underscores behind."""
    copy, mix_key = "copy", "mix_key"
    while copy in docs.columns:
        copy += "_"
    while mix_key in docs.columns:
        mix_key += "_"
    rates = source_rates(docs, weights, total, source)
    n_sources = docs.select(F.approx_count_distinct(source)).first()[0]
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"d.`{doc_id}`").cast("string"), F.lit("null")))
    d = d.select("d", F.col(f"d.`{source}`").alias("_source"), key.alias("_key"))
    rates = rates.select(F.col("source").alias("_of"), "draws", "cdf")
    on = F.expr("_source <=> _of")
    if n_sources > 50_000:  # salted: a source's documents are dealt to SALTS keys
        d = d.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)))
        rates = rates.withColumn("_part", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
        on = on & F.expr("_salt = _part")
    joined = d.join(small(rates, n_sources, 50_000), on)
    one = F.expr("size(filter(cdf, c -> c <= _u))")
    drawn = (
        joined.withColumn("_u", uniform(F.col("_key")))
        .withColumn("_first", one)
        .withColumn(
            "_count",
            F.expr(
                f"""if(draws = 1, _first, aggregate(sequence(2, greatest(draws, 2)), _first, (n, i) -> n + size(filter(cdf, c -> c <=
                      (cast(conv(substring(sha2(concat(_key, '#', cast(i as string)), 256), 1, 13), 16, 10) as double) + 0.5D) / {float(1 << 52)!r}D))))"""
            ),
        )
        .where("_count > 0")
        .select("d", "_key", F.explode(F.sequence(F.lit(1), F.col("_count"))).alias("_copy"))
        .withColumn("_mix", F.sha2(F.concat(F.col("_key"), F.lit("/"), F.col("_copy").cast("string")), 256))
    )
    return drawn.repartition("_mix").sortWithinPartitions("_mix").select("d.*", F.col("_copy").alias(copy), F.col("_mix").alias(mix_key))
