"""Phases and their registry. A phase works on all sources of a wave at once."""

from __future__ import annotations

import logging
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tags as G
from ..functions.text import missing_points, missing_product
from ..functions.vectors import valid_vector
from ..operators.split import split_oversized
from ..schema import KEY, RESULT, SPECS, schema
from .config import not_ready_budget
from .hooks import Manager, Veto, fold_all, managers, run_or_default

log = logging.getLogger(__name__)


class PhaseDeleteError(RuntimeError):
    """A phase could not delete what it made."""


class Phase(ABC):
    """id, label, dependencies and settings of a phase, and its work."""

    id: str = ""
    label: str = ""
    depends_on: tuple[str, ...] = ()
    settings_category: str | None = None
    settings_check: Any = None
    not_ready_budget_seconds: object = None

    @property
    def name(self) -> str:
        return self.id

    @property
    def display_label(self) -> str:
        return self.label or self.id

    def applies_to(self, sources: DataFrame) -> Column:
        """Null where the phase applies, else why it does not."""
        return F.lit(None).cast("string")

    @abstractmethod
    def process(self, sources: DataFrame, context: Any) -> DataFrame:
        """Results (key, status, reason, processed, expected, warnings): done, not_ready, error or skipped for each source."""

    @abstractmethod
    def delete(self, sources: DataFrame, context: Any) -> None:
        """Delete what the phase made of sources, or raise PhaseDeleteError."""

    def tag(self, settings: Any = None) -> str:
        return G.own_tag(self.id, G.relevant_settings(settings if settings is not None else {}, self.settings_check))

    def budget(self, env: object = None, generic: object = None) -> float:
        return not_ready_budget(self.not_ready_budget_seconds, env, generic)


class HookPhase(Phase):
    """A phase made of plain functions. What it has no function for is asked of
    the hooks of its owner's manager: ingestion_phase_run(phase, sources,
    context), ingestion_phase_purge(phase, sources, context) and
    ingestion_phase_settings_marker(phase)."""

    def __init__(self, id: str, process: Callable | None = None, delete: Callable | None = None, depends_on: Iterable[str] = (), label: str = "", settings_category: str | None = None, settings_check: Any = None, marker: Callable[[], Any] | None = None, owner: Manager | None = None, budget: object = None) -> None:
        self.id, self.label, self.depends_on = id, label, tuple(depends_on)
        self.settings_category, self.settings_check, self.not_ready_budget_seconds = settings_category, settings_check, budget
        self._process, self._delete, self._marker, self.owner = process, delete, marker, owner

    def process(self, sources: DataFrame, context: Any) -> DataFrame:
        """Results; without any function, or with one that gives none, an error for each source."""
        out = self._process(sources, context) if self._process else run_or_default(self.owner, "ingestion_phase_run", self.id, sources, context)
        return results(sources.select(*KEY)) if out is None else out

    def delete(self, sources: DataFrame, context: Any) -> None:
        """PhaseDeleteError unless a function did it and says so (anything but None)."""
        done = self._delete(sources, context) if self._delete else run_or_default(self.owner, "ingestion_phase_purge", self.id, sources, context)
        if done is None:
            raise PhaseDeleteError(f"phase {self.id} has nothing to delete with")

    def marker(self) -> Any:
        """(there, value) of what marks its settings; a function that fails counts as missing."""
        try:
            if self._marker is not None:
                return True, self._marker()
            if self.owner is not None and self.owner.has("ingestion_phase_settings_marker"):
                return True, self.owner.run("ingestion_phase_settings_marker", self.id)
        except Exception as e:  # noqa: BLE001 - a marker that cannot be made is a missing one
            log.warning("the settings marker of phase %s failed: %s", self.id, e)
        return False, None

    def tag(self, settings: Any = None) -> str:
        there, value = self.marker()
        if not there:
            return super().tag(settings) if settings else G.own_tag(self.id, G.declared_tag(self.id, self.settings_category, self.depends_on))
        return G.own_tag(self.id, f"{self.id}:unknown" if value is None else value)


class Registry:
    """Phases in the order of registration, the built-in ones first; of equal
    ids the first one stays. Hooks are those of the system's and an agent's manager."""

    def __init__(self, *phases: Phase, system: Manager | None = None, agent: Manager | None = None) -> None:
        self._phases: dict[str, Phase] = {}
        self.system, self.agent = system or Manager("system"), agent
        for p in phases:
            self.add(p)

    def add(self, phase: Phase) -> Registry:
        if not phase.id:
            raise ValueError("a phase needs an id")
        self._phases.setdefault(phase.id, phase)
        return self

    def __iter__(self):
        return iter(self._phases.values())

    def __contains__(self, phase: str) -> bool:
        return phase in self._phases

    def __getitem__(self, phase: str) -> Phase:
        return self._phases[phase]

    @property
    def managers(self) -> list[Manager]:
        return managers(self.system, self.agent)

    def specs(self, spark: SparkSession) -> DataFrame:
        check = lambda c: [c] if isinstance(c, str) else list(c) if isinstance(c, (list, tuple, set)) else None
        rows = [(p.id, p.display_label, i, p.settings_category, list(p.depends_on), check(p.settings_check)) for i, p in enumerate(self)]
        return spark.createDataFrame(rows, schema(SPECS))

    def hook(self, name: str, function: Callable, priority: int = 1) -> None:
        self.system.add(name, function, priority)

    def fold(self, name: str, value: Any, *args: Any) -> Any:
        """Pass value through the functions of a hook, the system's first; None keeps it, a Veto is raised."""
        return fold_all(self.managers, name, value, *args)


def results(df: DataFrame) -> DataFrame:
    """df with all columns of a result."""
    kinds = {f.name: f.dataType for f in schema(RESULT).fields}
    return df.select(*KEY, *[(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in kinds if c != "source"])


def utf8(content: Column) -> Column:
    """Bytes as text; what is no UTF-8 is replaced."""
    return F.decode(content, "UTF-8")


class ParsingChunking(Phase):
    """Texts of sources, or bytes that a parser makes texts of, into chunks
    within the embedder's budget, stored without vectors. Images that the
    contents carry become points of their own."""

    id, label, settings_category = "parsing_chunking", "Parsing and chunking", "chunker"

    def __init__(self, budget: int = 512, parse: Callable[[Column], Column] = utf8, merge_below: int = 0, tokens: Callable[[str], int] | None = None) -> None:
        """parse: a column of bytes to a column of texts. merge_below: characters
        below which a chunk is joined with the next. tokens: the embedder's own
        count; without it a third of the characters."""
        self.budget_tokens, self.parse, self.merge_below, self.tokens = budget, parse, merge_below, tokens

    def texts(self, contents: DataFrame) -> DataFrame:
        """(key, text, hash, bytes): the text given, else that of the bytes; hash and size are of the bytes, else of the text."""
        content = F.col("content") if "content" in contents.columns else F.lit(None).cast("binary")
        text = F.col("text") if "text" in contents.columns else F.lit(None).cast("string")
        raw = F.coalesce(content, F.encode(text, "UTF-8"))
        return contents.select(*KEY, F.coalesce(text, self.parse(content)).alias("text"), F.sha2(raw, 256).alias("hash"), F.octet_length(raw).alias("bytes"))

    def process(self, sources: DataFrame, context: Any) -> DataFrame:
        from ..operators.points import image_points, unembedded_points
        from ..operators.split import merge_short

        read = self.texts(context.contents.join(sources.select(*KEY), list(KEY), "left_semi"))
        texts = context.registry.fold("before_split", read.select(F.struct(*KEY).alias("doc_id"), "text"))
        chunks = split_oversized(texts, self.budget_tokens, tokens=self.tokens).where("length(trim(page_content)) > 0")
        if self.merge_below > 0:
            chunks = merge_short(chunks, self.merge_below)
        chunks = context.registry.fold("before_store", chunks.select("doc_id.*", F.col("chunk_ix").alias("chunk_index"), "page_content"))
        none = F.lit(None).cast("map<string,string>")
        chat = F.when(F.col("scope") != "agent", F.col("scope"))
        rows = chunks.join(read.select(*KEY, "hash"), list(KEY)).withColumns({"collection": F.when(F.col("scope") == "agent", "declarative").otherwise("episodic"), "chat_id": chat, "id": F.lit(None).cast("string"), "metadata": none, "run_metadata": none})
        made = unembedded_points(rows, context.now)
        if "images" in context.contents.columns:
            made = made.unionByName(image_points(context.contents.join(sources.select(*KEY), list(KEY), "left_semi"), context.now), allowMissingColumns=True)
        context.replace_points(made, sources)
        counts = context.points_of(sources).where("not coalesce(image, false)").groupBy(*KEY).agg(F.count("*").alias("n"))
        out = sources.select(*KEY).join(counts, list(KEY), "left").join(read.select(*KEY, "bytes"), list(KEY), "left").withColumn("n", F.coalesce("n", F.lit(0)))
        reason = F.when(F.col("bytes").isNull(), "the source cannot be read").otherwise(missing_product(F.col("bytes"), F.col("n")))
        return results(out.withColumns({"reason": reason, "status": F.when(reason.isNotNull(), "error").otherwise("done"), "processed": F.col("n"), "expected": F.col("n")}))

    def delete(self, sources: DataFrame, context: Any) -> None:
        """All points but catalogue cards, and the files of derived images."""
        from ..operators.points import with_card

        context.remove_images(sources)
        cards = with_card(context.points_of(sources)).where("is_card").drop("is_card")
        context.replace_points(context.stored(cards), sources)


class Embedding(Phase):
    """Vectors of stored chunks. Texts over the embedder's budget are split once
    more, catalogue cards excepted; images are embedded only if there is a
    function for them. Nothing is replaced before all vectors of the wave are computed."""

    id, label, depends_on, settings_category = "embedding", "Computing embeddings", ("parsing_chunking",), "embedder"

    def __init__(self, embed: Callable[[Column], Column], budget: int = 0, embed_image: Callable[[Column], Column] | None = None, tokens: Callable[[str], int] | None = None) -> None:
        """embed, embed_image: a column of texts, or of image files, to a column
        of vectors, built in or a vectorised function. budget: tokens that a text may have; 0 for any."""
        self.embed, self.embed_image, self.budget_tokens, self.tokens = embed, embed_image, budget, tokens

    def _within_budget(self, points: DataFrame) -> DataFrame:
        from ..operators.points import with_card

        marked = with_card(points)
        rest = marked.where("is_card").drop("is_card")
        texts = marked.where("not is_card").drop("is_card")
        pieces = split_oversized(texts.select("point_id", "page_content"), self.budget_tokens, "point_id", "page_content", self.tokens).select(F.col("doc_id").alias("point_id"), F.col("chunk_ix").alias("_ix"), F.col("page_content").alias("_piece"), "was_split")
        whole = texts.join(pieces, "point_id")
        key = F.when(F.col("was_split") & (F.col("_ix") > 0), F.concat("point_id", F.lit("-"), F.col("_ix").cast("string"))).otherwise(F.col("point_id"))
        return whole.withColumns({"point_id": key, "page_content": F.col("_piece")}).select(*points.columns).unionByName(rest)

    def process(self, sources: DataFrame, context: Any) -> DataFrame:
        points = context.points_of(sources)
        image = F.coalesce(F.col("image"), F.lit(False))
        texts = points.where(~image)
        if self.budget_tokens > 0:
            texts = self._within_budget(texts)
        vectors = texts.withColumn("vector", self.embed(F.col("page_content")).cast("array<float>"))
        pictures = points.where(image)
        vectors = vectors.unionByName(pictures.withColumn("vector", (self.embed_image(F.col("image_file")) if self.embed_image else F.lit(None)).cast("array<float>")))
        embedded = context.stored(vectors)
        wanted = ~image if self.embed_image is None else F.lit(True)
        counts = embedded.where(wanted).groupBy(*KEY).agg(F.count("*").alias("expected"), F.count_if(valid_vector(F.col("vector"))).alias("processed"))
        out = sources.select(*KEY).join(counts, list(KEY), "left").withColumns({"expected": F.coalesce("expected", F.lit(0)), "processed": F.coalesce("processed", F.lit(0))})
        nothing = F.when(F.col("expected") == 0, F.lit("there are no points to embed"))
        reason = F.coalesce(missing_points(F.col("expected"), F.col("processed")), nothing)
        out = context.stored(out.withColumns({"reason": reason, "status": F.when(reason.isNotNull(), "error").otherwise("done")}))
        good = out.where("status = 'done'")
        context.replace_points(embedded.join(good.select(*KEY), list(KEY), "left_semi"), good)
        return results(out)

    def delete(self, sources: DataFrame, context: Any) -> None:
        """Points with a real vector, catalogue cards excepted."""
        from ..operators.points import with_card

        points = with_card(context.points_of(sources))
        context.replace_points(context.stored(points.where(~valid_vector(F.col("vector")) | F.col("is_card")).drop("is_card")), sources)
