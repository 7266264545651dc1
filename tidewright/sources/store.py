"""Append-only tables under one folder of any store that Spark reaches.

Status rows, diary entries, markers, waits, timers and locks are logs of events
that are folded when read. Points are written in generations: a run appends the
points of its sources under a new generation and only then commits that
generation for them, so a reader sees the old points or the new ones, and a
crash in between leaves points that nobody reads.

All tables lie under an epoch. compact() writes what the folds give now as the
events of a new epoch, commits that and drops the old one, so reading costs what
has happened since, not the whole history. One writer for each store."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import status as S
from ..operators.claims import grant_locks
from ..schema import DIARY_EVENT, KEY, LOCKS, MARKERS, POINTS, STATUS_EVENT, TIMERS, WAITS, schema

GENERATION = "agent_id string, collection string, source string, chat_id string, generation long"
POINT_ROWS = f"{POINTS}, generation long"
LOGS = {"status": STATUS_EVENT, "diary": DIARY_EVENT, "markers": MARKERS, "waits": WAITS, "timers": TIMERS, "locks": LOCKS}


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of any store that Spark reaches, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Store:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._epoch: int | None = None
        self._seq: int | None = None

    def _table(self, path: str, ddl: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema(ddl)).parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema(ddl))

    @property
    def epoch(self) -> int:
        if self._epoch is None:
            self._epoch = self._table(f"{self.path}/epochs", "epoch int").agg(F.max("epoch")).first()[0] or 0
        return self._epoch

    def _at(self, name: str, epoch: int | None = None) -> str:
        return f"{self.path}/epoch-{self.epoch if epoch is None else epoch}/{name}"

    def _read(self, name: str, ddl: str | None = None) -> DataFrame:
        return self._table(self._at(name), ddl or LOGS[name])

    def _append(self, df: DataFrame, name: str, ddl: str | None = None, epoch: int | None = None) -> None:
        kind = schema(ddl or LOGS[name])
        cols = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields]
        out = df.select(*cols).write.mode("append")
        (out.partitionBy("agent_id") if "agent_id" in kind.names else out).parquet(self._at(name, epoch))

    # events

    def next_seq(self) -> int:
        """A number above those of all events so far; the logs are looked through once."""
        if self._seq is None:
            top = [self._read(n).agg(F.max("seq")).first()[0] for n in LOGS]
            self._seq = max([0, *(x for x in top if x is not None)])
        self._seq += 1
        return self._seq

    def add_status(self, events: DataFrame) -> None:
        self._append(events, "status")

    def add_diary(self, events: DataFrame) -> None:
        self._append(events, "diary")

    def status(self, agent_id: str | None = None, scope: str | None = None, source: str | None = None) -> DataFrame:
        """Current rows, without those whose last event is a deletion; of one agent, scope or source if it is given."""
        log = self._read("status")
        for column, wanted in (("agent_id", agent_id), ("scope", scope), ("source", source)):
            log = log if wanted is None else log.where(F.col(column) == wanted)
        return S.fold_status(log).where("status <> 'removed'")

    def diary(self, agent_id: str | None = None) -> DataFrame:
        log = self._read("diary")
        return S.fold_diary(log if agent_id is None else log.where(F.col("agent_id") == agent_id))

    def remove_status(self, keys: DataFrame, now: float) -> None:
        self.add_status(keys.select(*KEY).withColumns({"seq": F.lit(self.next_seq()), "ts": F.lit(now), "status": F.lit("removed")}))

    def _remove(self, rows: DataFrame, now: float) -> int:
        n = rows.count()
        self.remove_status(rows, now)
        return n

    def clear_agent(self, agent_id: str, now: float) -> int:
        """Remove all rows of an agent; how many there were. Markers are a table of their own and stay."""
        return self._remove(self.status(agent_id), now)

    def clear_chat(self, agent_id: str, chat_id: str, now: float) -> int:
        """Remove all rows of a conversation; how many there were."""
        return self._remove(self.status(agent_id, chat_id), now)

    def reset_agent(self, agent_id: str, phases: list[str]) -> int:
        """Drop diary entries of some phases from all rows of an agent, in every scope; how many rows changed."""
        hit = self.diary(agent_id).where(F.col("phase").isin(*phases)).select(*KEY, "phase")
        n = hit.select(*KEY).distinct().count()
        if n:
            self.add_diary(hit.withColumns({"seq": F.lit(self.next_seq()), "removed": F.lit(True)}))
        return n

    # markers, locks, waits and timers

    def add_marker(self, agent_id: str, kind: str, expires_at: float | None = None) -> None:
        self._append(self.spark.createDataFrame([(agent_id, kind, self.next_seq(), expires_at, False)], schema(MARKERS)), "markers")

    def clear_marker(self, agent_id: str, kind: str) -> None:
        self._append(self.spark.createDataFrame([(agent_id, kind, self.next_seq(), None, True)], schema(MARKERS)), "markers")

    def markers(self) -> DataFrame:
        """(agent_id, kind, expires_at): those whose last event did not clear them."""
        return fold_markers(self._read("markers"))

    def has_marker(self, agent_id: str, kind: str = "delete") -> bool:
        return bool(self.markers().where((F.col("agent_id") == agent_id) & (F.col("kind") == kind)).head(1))

    def lock(self, names: DataFrame, owner: str, now: float, ttl: float) -> DataFrame:
        """Take the locks (name) that are free; the names that were granted."""
        seq = self.next_seq()
        wanted = names.select("name", F.lit(owner).alias("owner"), F.lit(seq).alias("seq"))
        got = grant_locks(wanted, self._read("locks"), now)
        self._append(got.select("name", "owner", F.lit(seq).alias("seq"), F.lit(now).alias("ts"), F.lit(ttl).alias("ttl")), "locks")
        return self._read("locks").where(F.col("seq") == seq).select("name")

    def unlock(self, names: DataFrame, owner: str, now: float) -> None:
        self._append(names.select("name", F.lit(owner).alias("owner"), F.lit(self.next_seq()).alias("seq"), F.lit(now).alias("ts")), "locks")

    def add_waits(self, events: DataFrame) -> None:
        self._append(events, "waits")

    def waits(self) -> DataFrame:
        return self._read("waits")

    def add_timers(self, events: DataFrame) -> None:
        self._append(events, "timers")

    def timers(self) -> DataFrame:
        return self._read("timers")

    # points

    def replace_points(self, points: DataFrame, sources: DataFrame) -> None:
        """Make points the points of sources (agent_id, collection, source, chat_id); sources without points lose theirs."""
        done = self._read("generations", GENERATION)
        g = (done.agg(F.max("generation")).first()[0] or 0) + 1
        self._append(points.withColumn("generation", F.lit(g)), "points", POINT_ROWS)
        self._append(sources.select("agent_id", "collection", "source", "chat_id").distinct().withColumn("generation", F.lit(g)), "generations", GENERATION)

    def _point_rows(self) -> DataFrame:
        key = ["agent_id", "collection", "source"]
        last = self._read("generations", GENERATION).groupBy(*key, "chat_id").agg(F.max("generation").alias("generation"))
        p, g = self._read("points", POINT_ROWS).alias("p"), last.alias("g")
        same = F.col("p.chat_id").eqNullSafe(F.col("g.chat_id"))
        for c in [*key, "generation"]:
            same = same & (F.col(f"p.{c}") == F.col(f"g.{c}"))
        return p.join(g, same, "left_semi")

    def points(self) -> DataFrame:
        return self._point_rows()

    # compaction

    def compact(self) -> None:
        """Write the current state as a new epoch. A crash before its commit leaves the old one in force."""
        old, new = self.epoch, self.epoch + 1
        remove_path(self.spark, f"{self.path}/epoch-{new}")  # of a compaction that was cut short
        self.next_seq()
        self._append(status_snapshot(self.status()), "status", epoch=new)
        self._append(diary_snapshot(self._read("diary")), "diary", epoch=new)
        self._append(self.markers().withColumns({"seq": F.lit(3), "cleared": F.lit(False)}), "markers", epoch=new)
        for name in ("waits", "timers", "locks"):
            self._append(self._read(name), name, epoch=new)
        rows = self._point_rows()
        self._append(rows, "points", POINT_ROWS, epoch=new)
        self._append(rows.groupBy("agent_id", "collection", "source", "chat_id").agg(F.max("generation").alias("generation")), "generations", GENERATION, epoch=new)
        self.spark.createDataFrame([(new,)], "epoch int").write.mode("append").parquet(f"{self.path}/epochs")
        self._epoch = new
        remove_path(self.spark, f"{self.path}/epoch-{old}")


def fold_markers(events: DataFrame) -> DataFrame:
    last = events.groupBy("agent_id", "kind").agg(F.max_by(F.struct("cleared", "expires_at"), "seq").alias("m"))
    return last.where("not coalesce(m.cleared, false)").select("agent_id", "kind", F.col("m.expires_at").alias("expires_at"))


def status_snapshot(rows: DataFrame) -> DataFrame:
    """Events that fold to these rows: the first time, the time of the last error, and the rest."""
    key = [F.col(c) for c in KEY]
    first = rows.select(*key, F.lit(0).alias("seq"), F.col("created_at").alias("ts"))
    error = rows.where("error_at is not null").select(*key, F.lit(1).alias("seq"), F.col("error_at").alias("ts"), F.lit("error").alias("status"))
    rest = rows.select(*key, F.lit(2).alias("seq"), F.col("updated_at").alias("ts"), "type", "chat_id", "status", "error", "phase", "embedder_name", "chunker_name", "resume_created", "extra")
    return first.unionByName(error, allowMissingColumns=True).unionByName(rest, allowMissingColumns=True)


def diary_snapshot(events: DataFrame) -> DataFrame:
    """Events that fold to the same diary, entries in the same order."""
    f = events.groupBy(*KEY, "phase").agg(F.max_by(F.struct("removed", "entry"), "seq").alias("e"), F.min("seq").alias("first"), F.max("seq").alias("last")).where("not coalesce(e.removed, false)")
    kept = f.select(*KEY, "phase", F.col("last").alias("seq"), F.lit(False).alias("removed"), F.col("e.entry").alias("entry"))
    return kept.unionByName(f.where("first < last").select(*KEY, "phase", F.col("first").alias("seq"), F.lit(True).alias("removed")), allowMissingColumns=True)


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, content, hash): files with their bytes and the digest of these."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return f.select("path", F.substring_index("path", "/", -1).alias("name"), "content", F.sha2("content", 256).alias("hash"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(name, length) without reading any bytes."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return f.select(F.substring_index("path", "/", -1).alias("name"), "length")


def with_content(status: DataFrame, files: DataFrame) -> DataFrame:
    """status rows with the bytes of their file; a url has none, and files that are gone drop out."""
    f = files.select(F.col("name").alias("source"), "content")
    return status.where("type = 'file'").join(f, "source").unionByName(status.where("type = 'url'").withColumn("content", F.lit(None).cast("binary")))
