"""Splitting oversized chunks to an embedder's budget. The next window starts
where the last one ended, so a document is split in one place, by an Arrow
function; documents within the budget never leave the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import token_estimate

#: Words from which the size of the first window is guessed.
SAMPLE_WORDS = 200


def estimate(text: str) -> int:
    return max(1, len(text) // 3)


def split_text(text: str, budget: int, tokens: Callable[[str], int] = estimate) -> list[str]:
    """Pieces of whole words, each within the budget unless it is one word.
    Without a budget, or without words, the text is one piece as it is."""
    words = text.split()
    if budget is None or budget <= 0 or not words:
        return [text]
    fits = lambda a, b: tokens(" ".join(words[a:b])) <= budget
    head = words[:SAMPLE_WORDS]
    window = max(1, int(budget * len(head) / max(1, tokens(" ".join(head)))))
    out, at = [], 0
    while at < len(words):
        end = min(at + window, len(words))
        if not fits(at, end):
            good, bad = at, end  # the longest prefix that fits lies between
            while bad - good > 1:
                mid = (good + bad) // 2
                good, bad = (mid, bad) if fits(at, mid) else (good, mid)
            end = max(good, at + 1)
        out.append(" ".join(words[at:end]))
        at = end
    return out


def split_oversized(docs: DataFrame, budget: int, doc_id: str = "doc_id", text: str = "text", tokens: Callable[[str], int] | None = None) -> DataFrame:
    """(doc_id, chunk_ix, page_content, was_split): documents within the budget
    as they are, the others in pieces. A null text is empty. tokens: a
    tokenizer's count; without one a third of the characters."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    count = tokens or estimate
    kind = dict(d.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, at, pieces, split = [], [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                big = count(t) > budget
                parts = split_text(t, budget, count) if big else [t]
                ids += [i] * len(parts)
                at += range(len(parts))
                pieces += parts
                split += [big] * len(parts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(0).type), pa.array(at, pa.int32()), pa.array(pieces, pa.string()), pa.array(split, pa.bool_())], names=["doc_id", "chunk_ix", "page_content", "was_split"])

    schema = f"doc_id {kind}, chunk_ix int, page_content string, was_split boolean"
    if tokens is not None or budget <= 0:
        return d.mapInArrow(run, schema) if budget > 0 else d.select("doc_id", F.lit(0).alias("chunk_ix"), F.col("text").alias("page_content"), F.lit(False).alias("was_split"))
    big = token_estimate(F.col("text")) > budget
    whole = d.where(~big).select("doc_id", F.lit(0).alias("chunk_ix"), F.col("text").alias("page_content"), F.lit(False).alias("was_split"))
    return whole.unionByName(d.where(big).mapInArrow(run, schema))


def merge_short(chunks: DataFrame, least: int) -> DataFrame:
    """(doc_id, chunk_ix, page_content, was_split): chunks joined with the next
    ones, by a space, until they have `least` characters; the last may be
    shorter. A document's chunks are folded in its own row."""
    c = chunks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk_ix", "page_content"))).alias("c"), F.bool_or("was_split").alias("was_split"))
    fold = f"""aggregate(c, cast(array() as array<string>), (a, x) -> if(size(a) > 0 and length(a[size(a) - 1]) < {int(least)},
        concat(slice(a, 1, size(a) - 1), array(concat(a[size(a) - 1], ' ', x.page_content))), concat(a, array(x.page_content))))"""
    return c.select("doc_id", "was_split", F.posexplode(F.expr(fold)).alias("chunk_ix", "page_content")).select("doc_id", "chunk_ix", "page_content", "was_split")
