import datetime as dt

from tallyforge.operators.orphans import REFERENCES, Reference, orphan_counts, orphan_references, orphans_of

R = Reference("b", "id", "k", "at", "p", "k", "at")
T = lambda d: dt.datetime(2024, 1, d)
B, P, D = "id string, k string, at timestamp_ntz, kind string, earliest string", "k string, at timestamp_ntz", "parent_table string, key_value string"


def test_kinds(make):
    rows = [
        ("1", " A ", T(5), "x", "y"), ("1", " A ", T(5), "x", "y"), ("2", "a", T(1), None, None), ("3", "N/A", T(5), "", ""), ("4", None, T(5), "", ""), ("5", "  ", T(5), "", ""),
        ("6", "gone", None, "", ""), ("7", "nowhere", T(5), "", ""), ("8", "a", None, "", ""), (None, "nowhere", T(5), "", ""), ("9", "timeless", T(1), "", ""),
    ]
    parents = make(P, ("A", T(3)), ("a", T(4)), (None, T(1)), ("timeless", None))
    deleted = make(D, ("p", "GONE "), ("other", "nowhere"), ("p", "a"), ("p", None))
    got = {(r.bridge_id, r.kind, r.period) for r in orphans_of(make(B, *rows), parents, deleted, R).collect()}
    assert got == {("2", "late", "2024-01"), ("6", "deleted", "unknown"), ("7", "missing", "2024-01"), (None, "missing", "2024-01")}


def test_empty_tables(make):
    assert orphans_of(make(B), make(P), make(D), R).count() == 0
    assert [r.kind for r in orphans_of(make(B, ("1", "a", T(1), "", "")), make(P), make(D), R).collect()] == ["missing"]


def test_counts_of_all_references(spark):
    d = "/root/testdata/sf0.001"
    read = lambda n: spark.read.parquet(f"{d}/{n}.parquet")
    names = {r.bridge_table for r in REFERENCES} | {r.parent_table for r in REFERENCES}
    found = orphan_references({n: read(n) for n in names}, read("deleted_keys"))
    assert found.count() == found.distinct().count() == sum(r.n_rows for r in orphan_counts(found).collect())


def test_hot_key_is_not_shuffled(spark, make):
    b = spark.range(20_000).selectExpr("cast(id as string) id", "if(id % 3 = 0, 'hot', cast(id as string)) k", "timestamp_ntz'2024-01-01 00:00:00' at", "'' kind", "'' earliest")
    got = orphans_of(b, b.selectExpr("k", "at").filter("k <> 'hot'"), make(D), R)
    assert got.count() == 6667
