"""Recovery, claims, waits, deletion and heartbeats of the engine."""

import pytest
from pyspark.sql import functions as F
from test_engine import contents, embed, states

from tidewright.operators.split import merge_short
from tidewright.plans.config import EngineConfig
from tidewright.plans.engine import Engine
from tidewright.plans.hooks import Canceled
from tidewright.plans.phases import Embedding, HookPhase, ParsingChunking, PhaseDeleteError, Registry, results
from tidewright.schema import KEY


def done(sources, context):
    return results(sources.withColumn("status", F.lit("done")))


def engine(spark, path, *phases, **k):
    return Engine(spark, str(path / "store"), Registry(ParsingChunking(budget=5), Embedding(embed), *phases), pod="here", pid=1, **k)


def keys(spark, *names):
    return spark.createDataFrame([("a", "agent", n) for n in names], "agent_id string, scope string, source string")


def test_markers_can_be_set_again(spark, tmp_path):
    e = engine(spark, tmp_path)
    for _ in range(2):
        e.store.add_marker("a", "delete")
        assert e.store.has_marker("a")
        e.store.clear_marker("a", "delete")
        assert not e.store.has_marker("a")
    e.store.add_marker("a", "delete")
    with pytest.raises(Canceled):
        e.raise_if_canceled("a")
    assert e.ingest(contents(spark, d="x"), 1.0).count() == 0
    e.raise_if_canceled("b")
    absent = engine(spark, tmp_path, agents=spark.createDataFrame([("z",)], "agent_id string"))
    absent.store.clear_marker("a", "delete")
    assert absent.ingest(contents(spark, d="x"), 1.0).count() == 0  # its agent does not exist


def test_abandoned_phases_are_purged_and_run_again(spark, tmp_path):
    purged = []
    cards = HookPhase("cards", done, lambda s, c: purged.append("cards") or True, depends_on=("embedding",))
    e = engine(spark, tmp_path, cards, boot="one")
    c = contents(spark, d="x y", other="z")
    e.ingest(c, 1.0)
    e._write(keys(spark, "d"), "embedding", F.lit("processing"), started_at=F.lit(1.0), owner=F.expr("named_struct('pod', 'here', 'pid', 77, 'boot', 'zero')"))
    again = engine(spark, tmp_path, cards, boot="two", live_pids=[1, 77])
    again.now = 2.0
    assert again.recover(c).count() == 0 and states(again)["d", "embedding"] == "processing"  # its worker lives
    after = engine(spark, tmp_path, cards, boot="two")
    out = {r.source: r.status for r in after.ingest(c, 3.0).collect()}
    assert out == {"d": "completed", "other": "completed"} and purged == ["cards"]
    assert set(states(after).values()) == {"complete"}
    # a purge that fails keeps its source out of the pass
    bad = HookPhase("cards", done, lambda s, c: None, depends_on=("embedding",))
    after._write(keys(spark, "d"), "cards", F.lit("processing"), started_at=F.lit(1.0), owner=F.expr("named_struct('pod', 'there', 'pid', 1, 'boot', 'zero')"))
    held = engine(spark, tmp_path, bad, boot="three")
    held.now = 9000.0
    assert [r.source for r in held.recover(c).collect()] == ["d"]
    entry = held.store.diary().where("source = 'd' and phase = 'cards'").first().entry
    assert entry.state == "processing" and entry.owner is None and entry.started_at < 9000 - 1800 and "retrying" in entry.reason


def test_not_ready_waits_within_its_budget(spark, tmp_path):
    late = HookPhase("cards", lambda s, c: results(s.withColumns({"status": F.lit("not_ready"), "reason": F.lit("soon")})), lambda s, c: True, depends_on=("embedding",), budget=100)
    e = engine(spark, tmp_path, late)
    c = contents(spark, d="x y")
    assert e.ingest(c, 10.0).first().status == "processing"
    assert ("d", "cards") not in states(e)
    assert e.ingest(c, 60.0).first().status == "processing"
    out = e.ingest(c, 110.0).first()
    assert out.status == "error" and out.error == "phase cards not ready after 100s (max 100s): soon"
    e.forget(c, ["cards"])
    ready = engine(spark, tmp_path, HookPhase("cards", done, lambda s, c: True, depends_on=("embedding",)))
    assert ready.ingest(c, 120.0).first().status == "completed"


def test_deletion_goes_on_where_it_stopped(spark, tmp_path):
    calls, broken = [], [True]

    def delete(sources, context):
        calls.append("cards")
        if broken[0]:
            raise PhaseDeleteError("not now")
        return True

    files = []
    e = engine(spark, tmp_path, HookPhase("graph", done, lambda s, c: calls.append("graph") or True, depends_on=("cards",)), HookPhase("cards", done, delete, depends_on=("embedding",)), remove_files=lambda df: files.extend(r.name for r in df.collect()))
    c = contents(spark, d="x y")
    e.ingest(c, 1.0)
    with pytest.raises(PhaseDeleteError, match="cards: not now"):
        e.delete(keys(spark, "d"), 2.0)
    row = e.store.status().first()
    assert row.status == "deleting" and row.extra["deleted_phases"] == "graph,embedding,parsing_chunking" and calls == ["graph", "cards"]
    broken[0] = False
    assert e.delete(keys(spark, "d"), 3.0).first().route == "phases"
    assert calls == ["graph", "cards", "cards"] and e.store.status().count() == 0 and e.store.points().count() == 0 and files == ["d"]


def test_uninstalled_phases_and_teardown(spark, tmp_path):
    cards = HookPhase("cards", done, lambda s, c: True, depends_on=("embedding",))
    e = engine(spark, tmp_path, cards, HookPhase("graph", done, lambda s, c: True))
    c = contents(spark, d="x y", f="z")
    e.ingest(c, 1.0)
    fewer = engine(spark, tmp_path, cards)
    gone = fewer.delete(keys(spark, "d"), 2.0).first()
    assert (gone.route, gone.why) == ("rows", "uninstalled: graph")
    assert {r.source for r in fewer.store.status().collect()} == {"f"}
    e.store.add_marker("a", "delete")
    assert not e.before_file_delete("a", "agent", "f", 3.0)
    e.store.clear_marker("a", "delete")
    assert e.before_file_delete("a", "agent", "f", 4.0) and engine(spark, tmp_path).store.status().count() == 0


def test_reindexing_is_taken_up_again(spark, tmp_path):
    e = engine(spark, tmp_path, boot="one")
    c = contents(spark, d="x y")
    e.ingest(c, 1.0)
    e.now = 2.0
    mark = F.create_map(*map(F.lit, ("reindex", '{"pod":"here","pid":9,"boot":"zero"}', "reindex_at", "2.0")))
    e._status(c, status=F.lit("reindexing"), extra=mark)
    assert engine(spark, tmp_path, live_pids=[1, 9]).reindex_state().first().outcome == "live"
    new = engine(spark, tmp_path, boot="two")
    new.sweep(c, 3.0)
    row = new.store.status().first()
    assert row.status == "completed" and row.extra["reindex"] == "" and new.store.points().count() == 1
    assert e.reingest(c, 4.0).first().status == "completed"


def test_sweep_claims_and_collects(spark, tmp_path):
    e = engine(spark, tmp_path)
    c = contents(spark, d="x y", gone="z")
    e.uploaded(c, 1.0)
    quick = engine(spark, tmp_path)
    assert quick.sweep(c, 30.0).count() == 0  # too fresh
    assert engine(spark, tmp_path, config=EngineConfig(resume=False)).sweep(c, 1000.0).count() == 0
    assert {r.status for r in quick.sweep(c, 1000.0).collect()} == {"completed"}
    chats = spark.createDataFrame([], "agent_id string, chat_id string")
    files = spark.createDataFrame([("a", "agent", "d")], "agent_id string, scope string, name string")
    engine(spark, tmp_path, config=EngineConfig(collect_garbage=False)).sweep(c, 1001.0, chats, files)
    assert quick.store.status().count() == 2
    quick.sweep(c, 1002.0, chats, files)
    assert [r.source for r in quick.store.status().collect()] == ["d"] and {r.source for r in quick.store.points().collect()} == {"d"}
    assert quick.run(c, 1003.0)


def test_tags_of_old_entries_are_filled_in(spark, tmp_path):
    e = engine(spark, tmp_path)
    c = contents(spark, d="x y")
    e.ingest(c, 1.0)
    own = {r.phase: r for r in e._inputs().collect()}
    for p in ("parsing_chunking", "embedding"):
        e._write(keys(spark, "d"), p, F.lit("complete"), tag=F.lit(""), marker=F.lit(own[p].marker), marker_known=F.lit(True))
    n = e.store.points().count()
    assert e.pending(c).count() == 0
    e.ingest(c, 2.0)
    assert {r.phase: r.entry.tag for r in e.store.diary().collect()} == e.tags() and e.store.points().count() == n
    e._write(keys(spark, "d"), "embedding", F.lit("complete"), tag=F.lit(""), marker=F.lit("another"), marker_known=F.lit(True))
    assert {r.phase for r in e.pending(c).collect()} == {"embedding"}


def test_heartbeats_and_uploads(spark, tmp_path):
    e = engine(spark, tmp_path)
    u = spark.createDataFrame([("a", "agent", "http://x/y")], "agent_id string, scope string, source string")
    e.uploaded(u, 0.0)
    e.downloading(u, 10.0)
    assert [r.action for r in e.heartbeat(20.0).collect()] == ["wait"]
    assert [r.action for r in e.heartbeat(41.0).collect()] == ["beat"] and e.store.status().first().updated_at == 41.0
    assert [r.action for r in e.heartbeat(10.0 + 1800).collect()] == ["stop"] and e.heartbeat(2000.0).count() == 0
    e.downloaded(u, 2001.0)
    e.failed(u, "lost", 2002.0)
    row = e.report().first()
    assert (row.status, row.error, row.type, row.status_label) == ("error", "lost", "url", "Error")
    assert [r.action for r in e.heartbeat(9000.0).collect()] == ["stop"]


def test_compaction_keeps_what_folds_give(spark, tmp_path):
    e = engine(spark, tmp_path)
    e.ingest(contents(spark, d="x y", f="z"), 1.0)
    e.ingest(contents(spark, d="x y", f=" "), 2.0)
    e.store.add_marker("a", "maintenance", 99.0)
    e.store.add_marker("a", "delete")
    e.store.clear_marker("a", "delete")
    e.failed(keys(spark, "f"), "why", 3.0)
    look = lambda s: (sorted(s.status().collect(), key=str), sorted(s.diary().drop("first_seq").collect(), key=str), sorted(s.points().collect(), key=str), s.markers().collect())
    before = look(e.store)
    e.store.compact()
    assert look(e.store) == before and look(engine(spark, tmp_path).store) == before
    other = engine(spark, tmp_path)
    other.store.compact()
    assert look(other.store) == before and other.store.reset_agent("a", ["embedding"]) == 2 and other.store.clear_chat("a", "agent", 4.0) == 2
    assert other.store.status().count() == 0 and other.store.clear_agent("a", 5.0) == 0


def test_locks_of_the_store(spark, tmp_path):
    s = engine(spark, tmp_path).store
    names = spark.createDataFrame([("x",), ("y",)], "name string")
    assert s.lock(names, "me", 0.0, 300.0).count() == 2
    assert s.lock(names, "you", 1.0, 300.0).count() == 0
    s.unlock(names.where("name = 'x'"), "me", 2.0)
    assert [r.name for r in s.lock(names, "you", 3.0, 300.0).collect()] == ["x"]
    assert [r.name for r in s.lock(names, "you", 301.0, 300.0).orderBy("name").collect()] == ["x", "y"]


def test_bytes_images_and_cards(spark, tmp_path):
    files = []
    r = Registry(ParsingChunking(budget=50), Embedding(embed, budget=4, embed_image=lambda c: F.array(F.lit(2.0).cast("float"))))
    e = Engine(spark, str(tmp_path / "store"), r, remove_files=lambda df: files.extend(x.name for x in df.collect()))
    c = spark.createDataFrame([("a", "agent", "d", bytearray(b"some words that are more than one"), ["i1", "d"])], "agent_id string, scope string, source string, content binary, images array<string>")
    assert e.ingest(c, 1.0).first().status == "completed"
    p = e.store.points()
    assert p.where("image").count() == 2 and p.where("not coalesce(image, false)").count() > 1 and p.where("vector is null").count() == 0
    e.delete(c.select(*KEY), 2.0)
    assert set(files) == {"i1", "d"} and e.store.points().count() == 0


def test_short_chunks_join_the_next(spark):
    rows = [(1, i, t, False) for i, t in enumerate(["ab", "cd", "efghij", "k"])] + [(2, 0, "z", True)]
    out = merge_short(spark.createDataFrame(rows, "doc_id int, chunk_ix int, page_content string, was_split boolean"), 5)
    assert sorted((r.doc_id, r.chunk_ix, r.page_content, r.was_split) for r in out.collect()) == [(1, 0, "ab cd", False), (1, 1, "efghij", False), (1, 2, "k", False), (2, 0, "z", True)]


def test_sweeps_as_a_stream(spark, tmp_path):
    import time

    from tidewright.streaming import sweeps

    ran = []
    assert sweeps.start(spark, None, lambda: ran.append(1), str(tmp_path / "c")) is None and ran == [1]
    q = sweeps.every(spark, 0.2, lambda: ran.append(2), str(tmp_path / "d"))
    for _ in range(100):
        time.sleep(0.2)
        if len(ran) > 2:
            break
    q.stop()
    assert len(ran) > 2


def test_plans_do_not_grow_with_the_graph(spark):
    from tidewright.operators import graph

    src = spark.createDataFrame([("a", "agent", "s")], "agent_id string, scope string, source string")
    d = spark.createDataFrame([("a", "agent", "s", "p0", ("error", "x"))], "agent_id string, scope string, source string, phase string, entry struct<state:string,reason:string>")
    ddl = "id string, label string, pos int, settings_category string, depends_on array<string>, settings_check array<string>"
    size = {}
    for n in (3, 9):
        specs = spark.createDataFrame([(f"p{i}", "", i, None, [f"p{i - 1}"] if i else [], None) for i in range(n)], ddl)
        out = graph.propagate(src, specs, d)
        size[n] = len(out._jdf.queryExecution().optimizedPlan().toString().splitlines())
        assert {r.phase: r.entry.reason for r in out.collect()}[f"p{n - 1}"] == f"dependency p{n - 2} is error"
    assert size[9] == size[3]
