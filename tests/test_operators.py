import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyforge.operators import dml, incremental, joins, normalize, quality
from tallyforge.operators.versioned import VersionedTable

ROWS = st.lists(st.tuples(st.integers(0, 8), st.sampled_from(["a", "b", None])), max_size=12).map(lambda x: list({k: (k, v) for k, v in x}.values()))
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
S = "k long, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@FEW
@given(old=ROWS, new=ROWS)
def test_upsert_is_idempotent_and_complete(make, old, new):
    o, n = make(S, *old), make(S, *new)
    once = dml.merge_upsert(o, n, ["k"])
    assert rows(dml.merge_upsert(once, n, ["k"])) == rows(once) == sorted(({k: (k, v) for k, v in old} | {k: (k, v) for k, v in new}).values(), key=str)


@FEW
@given(old=ROWS, new=ROWS)
def test_merge_if_changed(make, old, new):
    o, n, want = dict(old), dict(new), {}
    want = {k: n.get(k, o.get(k)) if k in n else o[k] for k in {**o, **n}}
    assert rows(dml.merge_if_changed(make(S, *old), make(S, *new), ["k"], ["v"])) == sorted(want.items(), key=str)
    pruned = dml.merge_if_changed(make(S, *old), make(S, *new), ["k"], ["v"], prune=True)
    assert rows(pruned) == sorted(n.items(), key=str)
    legacy = {k: (o[k] if k in o and k in n and (o[k] is None or n[k] is None) else v) for k, v in want.items()}
    assert rows(dml.merge_if_changed(make(S, *old), make(S, *new), ["k"], ["v"], null_safe=False)) == sorted(legacy.items(), key=str)


@FEW
@given(snaps=st.lists(ROWS, min_size=1, max_size=3))
def test_history_has_one_open_version_per_key(make, snaps):
    h = make("k long, v string, valid_from date, valid_to date, is_current boolean, version int")
    seen = {}
    for i, s in enumerate(snaps):
        h = dml.scd2_apply(h, make(S, *s), "k", ["v"], F.lit(dt.date(2024, 1, 1 + i)))
        seen |= dict(s)
    got = h.collect()
    current = [r for r in got if r.is_current]
    assert {r.k: r.v for r in current} == seen and len(current) == len(seen)
    assert all((r.valid_to == dml.FAR_END) == r.is_current for r in got) and len({(r.k, r.version) for r in got}) == len(got)


def test_small_dml(make):
    o, n = make(S, (1, "a"), (2, None), (3, " ")), make(S, (1, None), (2, "x"), (4, "y"))
    assert rows(dml.merge_coalesce(o, n, ["k"], ["v"])) == [(1, "a"), (2, "x"), (3, " "), (4, "y")]
    assert rows(dml.fill_if_blank(o, make(S, (2, "f"), (3, "g"), (1, "no")), "k", "v")) == [(1, "a"), (2, "f"), (3, "g")]
    assert rows(dml.update_from(o, make(S, (1, None)), ["k"], ["v"])) == [(1, None), (2, None), (3, " ")]
    assert rows(dml.delete_keys(o, n, ["k"])) == [(3, " ")] and rows(dml.keep_keys(o, n, ["k"])) == [(1, "a"), (2, None)]
    assert rows(dml.replace_partitions(make(S, (1, "p"), (2, "p"), (3, "q")), make(S, (9, "p")), ["v"])) == [(3, "q"), (9, "p")]
    good, bad = dml.split_rejects(o, {"has_value": F.trim("v") != ""})
    assert rows(good) == [(1, "a")] and {r.k: r.rejected_for for r in bad.collect()} == {2: ["has_value"], 3: ["has_value"]}


def test_writers(spark, make, tmp_path):
    p = f"{tmp_path}/t"
    dml.write_full(make("k long, d string", (1, "x"), (2, "y")), p, ["d"])
    dml.write_partitions(make("k long, d string", (7, "x")), p, ["d"])
    assert rows(spark.read.parquet(p).select("k", "d")) == [(2, "y"), (7, "x")]
    dml.append_history(make(S, (5, "z")), f"{tmp_path}/h", F.lit("now"))
    dml.append_history(make(S, (6, "z")), f"{tmp_path}/h", F.lit("now"))
    assert spark.read.parquet(f"{tmp_path}/h").count() == 2


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["_write", "_publish", "_tidy", "create", "rename"])
@pytest.mark.parametrize("change", ["replace", "merge"])
def test_a_writer_that_stops_leaves_a_whole_table(spark, make, tmp_path, monkeypatch, step, change):
    """Stops before or after each step: readers see the old or the new table, and the next change goes through."""
    for after in (False, True):
        t = VersionedTable(spark, f"{tmp_path}/{after}", S, ["k"], 4)
        t.replace(make(S, (1, "a"), (2, "b")))
        t.replace(make(S, (1, "a"), (2, "b"), (3, "c")))
        do = lambda: t.replace(make(S, (9, "z"))) if change == "replace" else t.merge(make(S, (2, "x"), (4, "d")), [F.desc("v")])  # noqa: B023, E731
        new = [(9, "z")] if change == "replace" else [(1, "a"), (2, "x"), (3, "c"), (4, "d")]
        on = t._fs if step in ("create", "rename") else t
        real = getattr(on, step)

        def stopping(*a, real=real, after=after):
            if after:
                real(*a)
            raise Stop

        if on is t:
            monkeypatch.setattr(t, step, stopping)
        else:
            t._fs = type("Fs", (), {"__getattr__": lambda _, n, on=on: stopping if n == step else getattr(on, n)})()
        with pytest.raises(Stop):
            do()
        monkeypatch.undo()
        t._fs = on if on is not t else t._fs
        assert rows(t.read()) in ([(1, "a"), (2, "b"), (3, "c")], new)
        do()
        assert rows(t.read()) == new


def test_a_merge_writes_touched_buckets_only(spark, make, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/t", S, ["k"], 8)
    assert rows(t.read()) == []
    t.replace(make(S, *[(i, "a") for i in range(40)]))
    before = t.current()
    t.merge(make(S, (3, "b"), (3, "A")), [F.desc("v")])
    after = t.current()
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert rows(t.read()) == sorted(((i, "b" if i == 3 else "a") for i in range(40)), key=str)
    t.merge(make(S), [F.desc("v")])
    assert t.current() == after


@FEW
@given(values=st.lists(st.integers(-5, 25), max_size=15), bands=st.lists(st.tuples(st.integers(0, 20), st.one_of(st.none(), st.integers(0, 20))), max_size=6))
def test_band_join_against_a_loop(make, values, bands):
    bands = [(f"b{i}", float(a), None if b is None else float(max(a, b))) for i, (a, b) in enumerate(bands)]
    got = joins.in_band(make("id long, x double", *[(i, float(v)) for i, v in enumerate(values)]), "x", make("b string, lo double, hi double", *bands), "lo", "hi", 3.0)
    want = [(i, b) for i, v in enumerate(values) for b, lo, hi in bands if lo <= v and (hi is None or v <= hi)]
    assert rows(got.select("id", "b")) == sorted(want, key=str)


def test_join_plans_have_no_loop(spark, make):
    a, b = make("left_id long, x string, y string", (1, "a", "b"), (2, None, None)), make("right_id long, x string, y string", (5, "a", "b"), (6, "q", "b"))
    j = joins.any_key(a, b, [F.col("x"), F.col("y")], [F.col("x"), F.col("y")])
    assert rows(j) == [(1, 5), (1, 6)]
    plan = spark._jvm.PythonSQLUtils.explainString(j._jdf.queryExecution(), "formatted")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert rows(joins.anti(make(S, (1, "a"), (1, "b"), (None, "a")), make(S, (1, "a")), ["k", "v"])) == [(1, "b"), (None, "a")]
    top = joins.lookup_top(make(S, (1, "A"), (2, "z"), (3, None)), make("n string, c long, id string", ("a", 1, "low"), ("A", 9, "high")), F.lower("v"), F.lower("n"), [F.desc("c")], "id", "none")
    assert rows(top.select("k", "looked_up_id")) == [(1, "high"), (2, "none"), (3, "none")]


def test_watermarks(make):
    ts = lambda h: dt.datetime(2024, 1, 10, h)
    e = make("s string, t timestamp_ntz", ("a", ts(5)), ("a", ts(9)), ("b", dt.datetime(2023, 1, 1)), ("b", ts(20)))
    now = F.lit(ts(12)).cast("timestamp_ntz")
    m = incremental.high_watermark(e, "s", "t", now)
    assert {r.s: r.watermark for r in m.collect()} == {"a": ts(7), "b": None}
    assert incremental.since_watermark(e, m, "s", "t").count() == 3
    assert incremental.processing_mode(e, "t", now).first().mode == "full"
    c = incremental.completeness(e, F.col("s"), "t", F.lit(ts(9)).cast("timestamp_ntz")).first()
    assert (c.buckets, c.top_share, c.complete) == (1, 1.0, False)


@pytest.mark.parametrize(("age", "want"), [(0, 2), (30, 32), (200, 90), (None, 15)])
def test_lookback(make, age, want):
    d = dt.date(2024, 7, 1)
    df = make("c string, d date", ("x", None if age is None else d - dt.timedelta(age)))
    assert incremental.lookback(df, "c", "d", F.lit(d)).first().days == want


def test_work_and_duplicates(make):
    j = make("id long, body string, src string, n long", (1, "x" * 100, "b", 1), (2, "x" * 99, "a", 1), (3, "x" * 200, "a", 1), (3, "x" * 200, "b", 1), (None, "", "a", 1))
    done = make("id long, c double", (1, 0.2), (3, 0.9))
    ids = lambda m: sorted(r.id for r in incremental.work_to_do(j, done, "id", m, "body", "c").collect())
    assert ids("new_only") == [] and ids("failed_only") == [1] and ids("all") == [1, 3, 3]
    assert rows(incremental.across_sources(j.select("id", "src"), "id", ["src"])) == [(1, "b"), (2, "a"), (3, "a"), (None, "a")]
    assert [r.id for r in incremental.key_conflicts(j, "id", "src").collect()] == [3]
    with pytest.raises(ValueError):
        incremental.work_to_do(j, done, "id", "some", "body", "c")


def test_quality(spark, make):
    q = quality.review_queue(make("i string, c double, f long", ("x", 0.25, 600)), "i", "c", "f", 10, 25).first()
    assert q.priority == 175
    b = {(r.rating, r.action): r.share for r in quality.confidence_buckets(make("c double", (0.95,), (0.5,), (0.1,), (None,), (float("nan"),)), F.lit("g"), "c").collect()}
    assert set(b) == {("very high", "none"), ("low", "review"), ("very low", "rework")} and abs(sum(b.values()) - 100) < 1e-9
    u = quality.unique_check(make(S, (1, "a"), (1, "b"), (None, "c")), ["k"]).first()
    assert (u.duplicate_keys, u.null_keys) == (1, 1)
    assert quality.unique_check(make(S), ["k"]).first().null_keys == 0
    o = quality.orphan_check("n", make(S, (1, "a"), (2, "b"), (None, "c")), make(S, (1, "x")), "k").first()
    assert (o.n_rows, o.n_bad, o.severity) == (3, 1, "LOW")
    assert quality.drift({"ok": lambda: make(S), "broken": lambda: make(S).select("nope")}) == {"ok": "ok", "broken": "UNRESOLVED_COLUMN.WITH_SUGGESTION"}
    with pytest.raises(ValueError, match="keys"):
        quality.expect(make(S, (1, "a")), "keys")


def test_rules_of_many_words(make):
    rules = make("pattern string, standard string", ("one two three four five", "A"), ("b  c", "B"), ("six", "C"))
    df = make("id int, v string", (1, "One two three four five"), (2, "x one two three four five y"), (3, "B  C"), (4, "six"), (5, "four five"), (6, None))
    got = {r.id: (r.standard, r.how) for r in normalize.by_rules(df, "id", "v", rules).collect()}
    assert got == {1: ("A", "exact"), 2: ("A", "partial"), 3: ("B", "exact"), 4: ("C", "exact"), 5: ("four five", "none"), 6: (None, "none")}
