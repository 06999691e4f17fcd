"""Every core query on the smallest tables, against its oracle where it has one."""

import importlib
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
import __spark_entry__ as entry  # noqa: E402

D = "/root/testdata/sf0.001"
CORE = {n: f for m in entry.MODULES for n, f in importlib.import_module(m).QUERIES.items()}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(D).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    df = CORE[name](spark, D)
    cols = sorted(df.columns)
    got = sorted(str([plain(r[c]) for c in cols]) for r in df.collect())
    if sql := entry.oracle_sql().get(name):
        r = duck.execute(sql)
        names = [x[0] for x in r.description]
        assert sorted(names) == cols
        assert got == sorted(str([plain(x[names.index(c)]) for c in cols]) for x in r.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_nothing_in_the_core_needs_the_llm_package():
    root = Path(entry.__file__).parent
    for p in [*root.glob("tallyforge/**/*.py")]:
        if "llm" not in p.relative_to(root).parts:
            assert "tallyforge.llm" not in p.read_text(), p
