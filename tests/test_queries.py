"""Every registered query against its DuckDB equivalent."""

import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def _sorted(rows):
    return sorted(tuple(repr(v) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    rows = [tuple(r) for r in frame.select(*[f"`{c}`" for c in columns]).collect()]
    if name not in ORACLES:
        assert rows
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in result.fetchall()]
    assert _sorted(rows) == _sorted(expected)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(r["kept_events"] > 0 for r in rows)
