"""Every registered query against its SQL twin on the smallest data folder."""

from __future__ import annotations

import os
import re

import __spark_entry__ as entry_points
import pytest
from compare import compare, duck
from conftest import SF

from forecourt import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()
# The single checks, measures and cleaning steps are also part of the suites below; ALL_QUERIES=1 runs them too.
SINGLES = re.compile(r"dq_\d|md_\d|k_\d|cln_[01]|cln_2[0-3]|prf_[256]|snk_3|mdl_")
CHOSEN = sorted(n for n in QUERIES if os.environ.get("ALL_QUERIES") or not SINGLES.match(n))


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", CHOSEN)
def test_matches_twin(name, spark, loaded, con):
    assert compare(spark, con, SF, name, QUERIES[name], SQL[name]) is None


def test_entry_offers_them_all():
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
