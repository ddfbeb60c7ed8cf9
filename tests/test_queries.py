"""Every query of the core against its SQL on the smallest tables."""

import math

import pytest

from lectern.plans.all_queries import QUERIES, SQL
from tests.conftest import DATA


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = [[plain(r[c]) for c in columns] for r in df.collect()]
    if name not in SQL:
        assert rows
        return
    cur = duck.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == columns
    want = [[plain(r[names.index(c)]) for c in columns] for r in cur.fetchall()]
    assert sorted(map(repr, rows)) == sorted(map(repr, want))


def test_entry_point(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert out.count() > 0 and set(SQL) <= set(QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())
