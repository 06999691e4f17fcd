import pytest
from pyspark.sql import functions as F

from tallyforge.llm.mixture import Mixture

D = "doc_id long, source string, text string, n_tokens int, position string"
T = "source string, target_share double, max_repeats long"


def docs(make, **n):
    rows, i = [], 0
    for s, k in n.items():
        for _ in range(k):
            rows.append((i, s, "one two three four five", 0, ""))
            i += 1
    return make(D, *rows, (900, None, "no source", 0, ""), (901, "other", "not asked for", 0, ""), (902, "a", "", 0, ""), (903, "a", None, 0, ""))


def test_shares_are_met_where_repeats_allow(make):
    m = Mixture(docs(make, a=300, b=100, c=10), make(T, ("a", 0.6, 1), ("b", 0.3, 2), ("c", 0.1, 2), ("d", 0.0, 3)))
    s = {r.source: r for r in m.shares().collect()}
    assert set(s) == {"a", "b", "c"}
    assert s["c"].mixed_records == 20 and s["c"].passes == 2
    # What c can't give is asked from a and b at two to one.
    assert abs(s["a"].mixed_tokens - 2 * s["b"].mixed_tokens) <= 15 and abs(sum(r.actual_share for r in s.values()) - 1) < 1e-9
    p = m.placed()
    assert p.groupBy("doc_id", "source").count().filter("count > 2").isEmpty() and p.filter("doc_id >= 900").isEmpty()


def test_curriculum_orders_sources_over_the_run(make):
    m = Mixture(docs(make, a=400, b=400), make(T, ("a", 0.5, 1), ("b", 0.5, 1)), curriculum={"a": (2.0, 0.0), "b": (0.0, 1.0, 3.0)})
    early = {r.source: r.n for r in m.placed().filter("position < 0.5").groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(early["a"] - 300) <= 4 and abs(early["b"] - 400 * 0.25 / 1.25) <= 4
    pos = [r.position for r in m.ordered().select("position").collect()]
    assert pos == sorted(pos) and 0 <= pos[0] and pos[-1] <= 1


def test_budget_and_missing_source(make):
    m = Mixture(docs(make, a=100, b=100), make(T, ("a", 0.4, 1), ("b", 0.4, 1), ("none", 0.2, 5)), budget=400)
    s = {r.source: r for r in m.shares().collect()}
    assert s["none"].actual_share == 0 and s["a"].mixed_tokens == s["b"].mixed_tokens == 200


def test_empty(make):
    t = make(T, ("a", 1.0, 1))
    assert Mixture(make(D), t).ordered().count() == 0
    assert [r.mixed_tokens for r in Mixture(make(D), t).shares().collect()] == [0]
    assert Mixture(docs(make, a=3), make(T)).placed().count() == 0
    with pytest.raises(ValueError):
        Mixture(docs(make, a=3), t, curriculum={"a": (0.0, 0.0)}).placed()


def test_repeated_rows_are_records(make):
    rows = [(1, "a", "one two", 0, "")] * 4
    assert Mixture(make(D, *rows), make(T, ("a", 1.0, 1))).placed().count() == 4
