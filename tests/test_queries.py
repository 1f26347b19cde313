"""Every registered query against its SQL equivalent."""

from __future__ import annotations

import math
from datetime import datetime

import pytest

from queries.catalog import PIN_APPLIES, PIN_SOLD_OUT, QUERIES
from queries.oracle import oracle_sql, pinned, statement

ORACLE = oracle_sql()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value.isoformat() if isinstance(value, datetime) else value


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_an_equivalent():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(name, spark, duck, sf_dir):
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    result = duck.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    assert columns == sorted(names)
    places = [names.index(c) for c in columns]
    expected = [tuple(plain(row[i]) for i in places) for row in result.fetchall()]
    actual = [tuple(plain(row[c]) for c in columns) for row in found.collect()]
    assert actual, "the query should find something on the test data"
    assert "CartesianProduct" not in plan_of(found)
    assert in_order(actual) == in_order(expected)


def test_pinned_products_are_in_the_states_they_stand_for(duck):
    for product, state in ((PIN_APPLIES, (True, True)), (PIN_SOLD_OUT, (False, False))):
        text = statement("SELECT pin, (SELECT in_stock FROM pin_state) FROM pin_needed")
        assert duck.execute(pinned(text, product)).fetchone() == state
