import hashlib
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewright.functions import diary as D
from tidewright.functions import tags as G
from tidewright.functions import text as X
from tidewright.functions.vectors import is_card, matches_source, valid_vector
from tidewright.operators.split import estimate, split_text
from tidewright.plans.config import EngineConfig, allowed_engines, not_ready_budget
from tidewright.plans.hooks import Manager, MissingHook, Veto, accepts, first_compatible, fold_all, fold_shared, managers, run_on_all, run_or_default
from tidewright.plans.phases import HookPhase
from tidewright.schema import ENTRY


def one(spark, rows, ddl, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*cols).collect()]


def test_words_and_keys(spark):
    texts = ["", None, "a b", "a b c", "x\x1cy\x1fz", " \t\n"]
    got = one(spark, [(t,) for t in texts], "t string", X.word_count(F.col("t")))
    assert [g[0] for g in got] == [len((t or "").split()) for t in texts]
    key = one(spark, [("é.txt",)], "s string", X.status_key(F.lit("a"), F.lit("agent"), F.col("s")))[0][0]
    assert key == "agents:a:ingestion:agent:" + hashlib.sha256("é.txt".encode()).hexdigest()
    card = one(spark, [("d.pdf", 3, None), ("d.pdf", 0, None), ("d.pdf", 3, 7), ("d.pdf", 3, 0)], "s string, i int, t int", X.catalogue_card_id(F.lit("a"), F.lit(None).cast("string"), F.col("s"), F.col("i"), F.col("t")))
    want = [uuid.uuid5(uuid.NAMESPACE_URL, "catalogue_card:a::d.pdf" + tail).hex for tail in (":3", "", ":s7", "")]
    assert [c[0] for c in card] == want


def test_names(spark):
    rows = [("MathAwareSemanticChunkerSettings", None, "MathAwareSemanticChunker"), ("math-aware-chunker", None, "math-aware-chunker"), (None, None, None), (" ", "CSettings", "C"), ("Settings", None, "Settings")]
    got = one(spark, [r[:2] for r in rows], "n string, c string", X.chunker_name(F.col("n"), F.col("c")))
    assert [g[0] for g in got] == [r[2] for r in rows]
    url = one(spark, [("https://e.com/a/b c.tar.pdf?x#y",), ("https://e.com/",)], "u string", X.persisted_url_name(F.col("u")))
    assert url[0][0].endswith("_b_c.tar.pdf") and url[1][0].endswith("_index")
    kept = one(spark, [({"model": "m", "openai_api_key": "x"},)], "v map<string,string>", X.material_settings(F.col("v")))
    assert kept == [({"model": "m"},)]


def test_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(None,), ([],), ([0.0, 0.0],), ([inf, 1.0],), ([nan],), ([None, 1.0],), ([1e-13],), ([0.5],)]
    assert [r[0] for r in one(spark, rows, "v array<double>", valid_vector(F.col("v")))] == [False] * 7 + [True]
    m = matches_source(F.col("s"), F.col("c"), F.lit("a"), F.lit(None).cast("string"))
    assert [r[0] for r in one(spark, [("a", None), ("a", ""), ("a", "x"), (None, None)], "s string, c string", m)] == [True, True, False, False]
    assert [r[0] for r in one(spark, [(True, "k"), (True, "z"), (None, "k")], "f boolean, k string", is_card(F.col("f"), F.col("k"), F.lit("k")))] == [True, False, False]


def entries(spark, rows):
    """rows of (state, started_at, owner) as a column e; None is no entry."""
    full = [(None if r is None else (r[0], None, r[1], r[2], None, None, None, None, None, None, None),) for r in rows]
    return spark.createDataFrame(full, f"e {ENTRY}")


def test_abandonment(spark):
    now, old = 10_000.0, 10_000.0 - 1860
    cases = [
        (("complete", None, None), False), (None, False), (("processing", now, None), False), (("processing", old, None), True), (("processing", None, None), True),
        (("processing", old, ("self", 1, "cur")), False), (("processing", now, ("self", 7, "old")), False), (("processing", now, ("self", 999999, "old")), True),
        (("processing", now, ("foreign", 1, "x")), False), (("processing", old, ("foreign", 1, "x")), True), (("running", old, None), True),
    ]
    live = F.array(F.lit(7))
    got = entries(spark, [c[0] for c in cases]).select(D.should_abandon(F.col("e"), F.lit(now), F.lit("self"), F.lit("cur"), live)).collect()
    assert [r[0] for r in got] == [c[1] for c in cases]
    edge = entries(spark, [("processing", now - 1800, None)]).select(D.lease_expired(F.col("e"), F.lit(now))).first()[0]
    assert edge is False  # strictly more than the lease


def test_states_and_results(spark):
    got = entries(spark, [None, ("processing", None, None), (None, None, None), ("odd", None, None), ("running", None, None), ("skipped", None, None)]).select(D.phase_state(F.col("e"))).collect()
    assert [r[0] for r in got] == ["pending", "processing", "complete", "complete", "processing", "skipped"]
    s, r = D.coerce_result(F.lit("p"), F.col("s"), F.lit("why"))
    assert [x[0] for x in one(spark, [("done",), ("error",), (None,), ("junk",)], "s string", s)] == ["done", "error", "error", "error"]
    w = one(spark, [([("c", "m"), (None, "m"), ("c", None)],)], "w array<struct<code:string,message:string>>", F.size(D.normalize_warnings(F.col("w"))))
    assert w == [(1,)]
    assert [x[0] for x in one(spark, [("7",), ("0",), ("x",), (None,)], "a string", D.retry_after(F.col("a")))] == [7.0, 5.0, 5.0, 5.0]


class P(HookPhase):
    def __init__(self, id, depends_on=(), check=None):
        super().__init__(id, depends_on=depends_on, settings_check=check)


def test_tags():
    settings = {"a": {"model": "m1"}, "b": {"k": 1}, "x": {"k": 9}}
    graph = [P("a"), P("b", ("a",)), P("x")]
    first = G.resolve_tags(settings, graph)
    assert first == G.resolve_tags(settings, list(reversed(graph)))
    deep = G.resolve_tags(settings | {"a": {"model": "m2"}}, graph)
    assert deep["a"] != first["a"] and deep["b"] != first["b"] and deep["x"] == first["x"]
    narrow = [P("a", (), ["model"])]
    assert G.resolve_tags({"a": {"model": "m", "z": 1}}, narrow) == G.resolve_tags({"a": {"model": "m"}}, narrow)
    assert G.relevant_settings({"model": 1, "m": 2}, "model") == {"model": 1} and G.relevant_settings([1], ["a"]) == {}

    class Own(P):
        def tag(self, settings=None):
            return "mine"

    assert G.resolve_tags({}, [Own("a"), P("a")]) == {"a": G.compose_tag("mine", (), {})}  # its own tag counts, and the first of equal ids
    assert G.current_tag({}, [P("a", ("a",))], "a") == G.fallback_tag("a", None, ("a",))
    assert HookPhase("a", marker=lambda: None).tag({"x": 1}) == G.own_tag("a", "a:unknown")
    assert HookPhase("a", marker=lambda: 1 / 0).tag() == G.own_tag("a", "a:-:")
    with pytest.raises(G.TagCycleError, match="a -> b -> a"):
        G.resolve_tags({}, [P("a", ("b",)), P("b", ("a",))])
    with pytest.raises(G.TagError, match="nothing"):
        G.resolve_tags({}, [P("a", ("nothing",))])
    assert G.compose_tag("o", (), {}) == hashlib.sha256(b"o|").hexdigest()
    assert G.canonical_json({"b": "é", "a": [1, 2]}) == '{"a":[1,2],"b":"é"}'


def test_budgets():
    assert not_ready_budget(300) == 300 and not_ready_budget(None) == 3600 and not_ready_budget("300") == 300
    assert not_ready_budget(300, env="120") == 120
    for junk in ("inf", "nan", -1, True, "x"):
        assert not_ready_budget(junk) == 3600
    c = EngineConfig.load({"reembed_max_concurrency": 3}, env={})
    assert c.max_concurrency == 3 and c.boot_threshold == 60 and c.download_threshold == 300
    assert EngineConfig.load({"reembed_max_concurrency": 3, "max_concurrency": 4}, env={}).max_concurrency == 4


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab cé", min_size=1, max_size=40), max_size=60), st.integers(1, 40))
def test_split_keeps_words_and_budget(parts, budget):
    text = " ".join(parts)
    out = split_text(text, budget)
    if not text.split():
        assert out == [text]
        return
    assert " ".join(out).split() == text.split()
    assert all(estimate(p) <= budget or len(p.split()) == 1 for p in out)


def test_split_without_budget():
    assert split_text("a  b", 0) == ["a  b"]


def test_hooks():
    system, agent = Manager("system"), Manager("agent")
    system.add("h", lambda v: v + "s").add("h", lambda v, lizard=None: None)
    agent.add("h", lambda v, **k: v + "a" + k.get("cat", ""), 5)
    assert fold_all(managers(system, agent), "h", "x", caller="!") == "xsa!" and fold_shared(system, agent, "h", "x") == "xas"
    assert managers(system, system) == [system] and managers(None, agent) == [agent]
    agent.add("h", lambda v: 1 / 0)
    assert agent.fold("h", "x") == "xa"  # a failure is logged
    system.add("veto", lambda v: (_ for _ in ()).throw(Veto("no")))
    with pytest.raises(Veto):
        system.fold("veto", 1)
    with pytest.raises(MissingHook):
        system.run("nothing")
    assert run_or_default(system, "nothing", default=7) == 7 and run_or_default(None, "h", default=8) == 8
    with pytest.raises(ZeroDivisionError):
        run_on_all([system, agent], "h", "x")
    assert run_on_all([system], "h", "x", default=0) == "xs"
    assert accepts(lambda cat: 0, "cat") and accepts(lambda **k: 0, "cat") and not accepts(lambda c: 0, "cat")
    marks = Manager("agent").add("m", lambda a, b: 1).add("m", lambda a: a + "!")
    assert first_compatible(marks, "m", "p") == "p!" and first_compatible(marks, "m", default=3) == 3
    assert HookPhase("p", owner=Manager("agent").add("ingestion_phase_settings_marker", lambda phase: phase * 2)).tag() == G.own_tag("p", "pp")


def test_configuration():
    c = EngineConfig.load({}, env={"TIDEWRIGHT_BOOT": "9", "TIDEWRIGHT_WORKERS": "2", "TIDEWRIGHT_NICENESS": "5", "TIDEWRIGHT_SWEEP": "60", "TIDEWRIGHT_RESUME_ENABLED": "off", "TIDEWRIGHT_LOCK": "nan"})
    assert (c.boot_threshold, c.pool, c.sweep_every, c.resume, c.lock_timeout) == (9.0, "tidewright-5", 60.0, False, 300.0)
    assert EngineConfig().pool is None and allowed_engines([]) == [EngineConfig] == allowed_engines([EngineConfig]) and EngineConfig.engine_class().__name__ == "Engine"
