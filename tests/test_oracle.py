"""Every registered query equals its SQL on whole tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from corpusloom.plans.catalog import QUERIES
from corpusloom.plans.catalog_sql import ORACLE
from tests.oracle import connect, difference


def test_entry(spark):
    rows = {r.split: r for r in entry(spark).collect()}
    assert set(rows) == {"train", "test"} and all(r.n > 0 and r.n_tokens > r.n for r in rows.values())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_small, name):
    rows = queries()[name](spark, sf_small).toPandas()
    assert difference(rows, connect(sf_small).sql(oracle_sql()[name]).df()) is None
