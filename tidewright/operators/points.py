"""Points of the vector store: what a purge removes, what embedding may write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import catalogue_card_id
from ..functions.vectors import is_card, point_key, valid_vector


def with_card(points: DataFrame) -> DataFrame:
    key = point_key(F.col("point_id"), F.col("payload_id"))
    card = catalogue_card_id(F.col("agent_id"), F.col("chat_id"), F.col("source"), F.coalesce("chunk_index", F.lit(0)), F.col("start_index"))
    return points.withColumn("is_card", is_card(F.col("is_catalogue_card"), key, card))


def purge_parsing(points: DataFrame) -> DataFrame:
    """Points that a purge of parsing removes: all but catalogue cards."""
    return with_card(points).where("not is_card").drop("is_card")


def purge_embedding(points: DataFrame) -> DataFrame:
    """Points that a purge of embedding removes: those with a real vector, cards excepted."""
    return with_card(points).where(~F.col("is_card") & valid_vector(F.col("vector"))).drop("is_card")


def stored_sources(points: DataFrame) -> DataFrame:
    """(agent_id, source, chat_id, chunks) with points other than cards: what the store itself shows as parsed."""
    return purge_parsing(points).groupBy("agent_id", "source", "chat_id").agg(F.count("*").alias("chunks"))


def unembedded_points(chunks: DataFrame, when: float) -> DataFrame:
    """Points with no vector yet from chunks (agent_id, collection, source,
    chat_id, id, page_content, hash, metadata, run_metadata): run metadata wins
    over that of the chunk; the id is the chunk's, else one made of its place."""
    merged = F.map_zip_with(F.coalesce("metadata", F.create_map().cast("map<string,string>")), F.coalesce("run_metadata", F.create_map().cast("map<string,string>")), lambda k, a, b: F.coalesce(b, a))
    made = F.sha2(F.concat_ws("\u001f", "agent_id", "collection", "chat_id", "source", F.col("chunk_index").cast("string")), 256)
    return chunks.select(
        "agent_id", "collection", F.coalesce("id", F.left(made, F.lit(32))).alias("point_id"), "source", "chat_id", "page_content", "hash", F.lit(when).alias("when"),
        "chunk_index", merged.alias("extra"), F.lit(None).cast("array<float>").alias("vector"),
    )


def embedding_gate(points: DataFrame, key: list[str]) -> DataFrame:
    """(key, intended, valid, outcome): error if there is nothing to write or no valid vector; a mix proceeds."""
    counted = points.groupBy(*key).agg(F.count("*").alias("intended"), F.count_if(valid_vector(F.col("vector"))).alias("valid"))
    return counted.withColumn("outcome", F.when((F.col("intended") == 0) | (F.col("valid") == 0), "error").otherwise("done"))


def image_files(points: DataFrame) -> DataFrame:
    """(agent_id, source, image_file) of derived images; the source's own file is not among them."""
    return points.where("image and image_file is not null").select("agent_id", "source", "image_file").distinct()


def image_points(contents: DataFrame, when: float) -> DataFrame:
    """Points without a vector for the images of contents (key, images array<string>): one for each file."""
    chat = F.when(F.col("scope") != "agent", F.col("scope"))
    rows = contents.select("agent_id", F.when(F.col("scope") == "agent", "declarative").otherwise("episodic").alias("collection"), "source", chat.alias("chat_id"), F.posexplode("images").alias("chunk_index", "image_file"))
    made = F.sha2(F.concat_ws("\u001f", "agent_id", "collection", "chat_id", "source", F.lit("image"), "image_file"), 256)
    return rows.select("agent_id", "collection", F.left(made, F.lit(32)).alias("point_id"), "source", "chat_id", F.lit("").alias("page_content"), F.lit(when).alias("when"), F.lit(True).alias("image"), "image_file", "chunk_index", F.lit(None).cast("array<float>").alias("vector"))


def point_meta(metadata: Column) -> Column:
    """The metadata of a point; none is an empty map."""
    return F.coalesce(metadata, F.create_map().cast("map<string,string>"))
