"""Registered queries of the subpackage: all operators and the pipeline, and those with SQL against it."""

import re

import pytest

import __spark_entry__ as entry
from caselode.llm.queries import QUERIES
from caselode.llm.sql import ORACLE_SQL
from checks.compare import database, difference


def test_every_operator_has_one_query():
    assert [int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_sql(spark, folder, name):
    assert difference(QUERIES[name](spark, folder).toPandas(), database(folder).execute(ORACLE_SQL[name]).df()) is None
