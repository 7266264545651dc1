import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewright.operators import graph, lifecycle, status
from tidewright.plans.engine import Engine
from tidewright.plans.phases import Embedding, HookPhase, ParsingChunking, Phase, PhaseDeleteError, Registry, results
from tidewright.schema import STATUS_EVENT, schema
from tidewright.streaming import liveness


def embed(text):
    return F.array(F.length(text).cast("float"), F.lit(1.0).cast("float"))


def contents(spark, **texts):
    return spark.createDataFrame([("a", "agent", k, v) for k, v in texts.items()], "agent_id string, scope string, source string, text string")


def states(engine):
    return {(r.source, r.phase): r.entry.state for r in engine.store.diary().collect()}


def test_ingest_again_and_after_changes(spark, tmp_path):
    registry = Registry(ParsingChunking(budget=5), Embedding(embed))
    e = Engine(spark, str(tmp_path / "store"), registry, settings={"chunker": {"n": "1"}, "embedder": {"m": "1"}})
    c = contents(spark, one="some words that are more than one chunk holds", two="short")
    out = {r.source: r.status for r in e.ingest(c, 100.0).collect()}
    assert out == {"one": "completed", "two": "completed"}
    assert set(states(e).values()) == {"complete"}
    n = e.store.points().count()
    assert n > 2 and e.store.points().where("vector is null").count() == 0
    assert e.pending(c).count() == 0
    # another embedder makes only the embedding stale; another chunker both
    other = Engine(spark, str(tmp_path / "store"), registry, settings={"chunker": {"n": "1"}, "embedder": {"m": "2"}})
    assert {r.phase for r in other.pending(c).collect()} == {"embedding"}
    other.ingest(c, 200.0)
    assert other.pending(c).count() == 0 and other.store.points().count() == n
    third = Engine(spark, str(tmp_path / "store"), registry, settings={"chunker": {"n": "2"}, "embedder": {"m": "2"}})
    assert {r.phase for r in third.pending(c).collect()} == {"parsing_chunking", "embedding"}
    other.delete(c.where("source = 'one'"), 300.0)
    assert {r.source for r in other.store.status().collect()} == {"two"}
    assert {r.source for r in other.store.points().collect()} == {"two"}


def test_empty_product_and_propagation(spark, tmp_path):
    registry = Registry(ParsingChunking(budget=5), Embedding(embed), HookPhase("cards", lambda s, ctx: results(s.withColumn("status", F.lit("done"))), lambda s, ctx: None, depends_on=("embedding",)))
    e = Engine(spark, str(tmp_path / "store"), registry)
    out = {r.source: (r.status, r.error) for r in e.ingest(contents(spark, blank="   ", good="x y"), 1.0).collect()}
    assert out["good"][0] == "completed"
    assert out["blank"][0] == "error" and "no chunks from 3 bytes" in out["blank"][1]
    s = states(e)
    assert s["blank", "embedding"] == "error" and s["blank", "cards"] == "error" and s["good", "cards"] == "complete"


def test_zero_vectors_are_an_error_and_keep_the_old_points(spark, tmp_path):
    store = str(tmp_path / "store")
    Engine(spark, store, Registry(ParsingChunking(), Embedding(embed)), settings={"embedder": {"m": "1"}}).ingest(contents(spark, d="x y"), 1.0)
    zero = Engine(spark, store, Registry(ParsingChunking(), Embedding(lambda t: F.array(F.lit(0.0)))), settings={"embedder": {"m": "2"}})
    out = zero.ingest(contents(spark, d="x y"), 2.0).first()
    assert out.status == "error" and "stored no points for 1 point(s)" in out.error
    assert [list(r.vector) for r in zero.store.points().collect()] == [[3.0, 1.0]]


def test_phase_needs_delete_and_registry_keeps_the_first(spark):
    with pytest.raises(TypeError):
        type("Half", (Phase,), {"process": lambda self, s, c: s})()
    with pytest.raises(PhaseDeleteError):
        HookPhase("h", lambda s, c: s).delete(None, None)
    a, b = HookPhase("x", print, label="first"), HookPhase("x", print, label="second")
    assert Registry(a, b)["x"].display_label == "first"


def test_graph_orders():
    class P:
        def __init__(self, id, *deps):
            self.id, self.depends_on = id, deps

    scrambled = [P("beta", "alpha"), P("gamma", "beta"), P("alpha")]
    assert [p.id for p in graph.execution_order(scrambled)] == ["alpha", "beta", "gamma"]
    assert [p.id for p in graph.dependency_ordered(scrambled)] == ["alpha", "beta", "gamma"]
    cycle = [P("a", "b"), P("b", "a")]
    assert len(graph.execution_order(cycle)) == len(graph.dependency_ordered(cycle)) == 2


def test_diamond_names_the_first_declared(spark):
    ddl = "id string, label string, pos int, settings_category string, depends_on array<string>, settings_check array<string>"
    key = "agent_id string, scope string, source string"
    src = spark.createDataFrame([("a", "agent", "s")], key)
    diary = spark.createDataFrame([("a", "agent", "s", "B", ("error", "x")), ("a", "agent", "s", "C", ("skipped", "y"))], key + ", phase string, entry struct<state:string,reason:string>")
    for deps, want in ((["B", "C"], "dependency B is error"), (["C", "B"], "dependency C is skipped")):
        specs = spark.createDataFrame([("B", "", 0, None, [], None), ("C", "", 1, None, [], None), ("D", "", 2, None, deps, None)], ddl)
        assert graph.first_offender(src, specs, diary).first().reason == want


def test_downstream_of_a_cycle_ends(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "b")], "id string, dep string")
    assert {r.id for r in graph.downstream(edges, "a", 8).collect()} == {"b", "c"}


def test_status_fold(spark):
    rows = [
        ("a", "agent", "s", 1, 10.0, "file", None, "uploaded", None, None, None, None, None, True, {"x": "1"}),
        ("a", "agent", "s", 2, 20.0, None, None, "processing", None, "parsing_chunking", None, None, "C", None, {"x": "2", "y": "3"}),
        ("a", "agent", "s", 3, 30.0, None, None, "error", "boom", None, None, None, None, None, None),
        ("a", "agent", "s", 4, 40.0, None, None, "completed", None, None, True, None, None, None, None),
    ]
    r = status.fold_status(spark.createDataFrame(rows, schema(STATUS_EVENT))).first()
    assert (r.status, r.error, r.error_at, r.created_at, r.updated_at, r.phase, r.chunker_name, r.resume_created, r.extra) == ("completed", None, 30.0, 10.0, 40.0, None, "C", None, {"x": "2", "y": "3"})


def test_claims(spark):
    rows = [("completed", 0.0, None), ("processing", 0.0, None), ("processing", 95.0, None), ("deleting", 0.0, None), ("uploaded", 50.0, True), ("error", 0.0, None)]
    df = spark.createDataFrame(rows, "s string, u double, r boolean")
    got = [x[0] for x in df.select(lifecycle.claimable(F.col("s"), F.col("u"), F.col("r"), F.lit(100.0), 60.0)).collect()]
    assert got == [False, True, False, False, False, True]
    assert df.select(lifecycle.claimable(F.col("s"), F.col("u"), F.col("r"), F.lit(100.0), 60.0, claim_completed=True)).first()[0] is True


def test_markers(spark, tmp_path):
    e = Engine(spark, str(tmp_path / "store"), Registry(ParsingChunking()))
    e.store.add_marker("a", "delete")
    assert e.ingest(contents(spark, d="x"), 1.0).count() == 0
    e.store.clear_marker("a", "delete")
    assert e.store.markers().count() == 0


def test_leases_of_a_stream(spark, tmp_path):
    at = lambda m: dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=m)
    rows = [("a", "agent", "s", at(m)) for m in (0, 10, 20, 120)] + [("a", "agent", "t", at(0)), ("a", "agent", "t", at(300))]
    ddl = "agent_id string, scope string, source string, ts timestamp"
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
    liveness.drain(liveness.leases(s), str(tmp_path / "out"), str(tmp_path / "check"))
    got = {(r.source, r.since, r.beats) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("s", at(0), 3), ("s", at(120), 1), ("t", at(0), 1)}
    waits = spark.createDataFrame([("a", "agent", "s", "p", at(m)) for m in (0, 5, 10)], ddl.replace("ts", "phase string, ts"))
    r = liveness.not_ready(waits, 600).first()
    assert r.attempts == 3 and r.over_budget
