"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

from compare import connect, difference
from pitbars.plans import oracle
from pitbars.plans.catalogue import REGISTRY

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(REGISTRY) == set(oracle.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the warehouse tables")
@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, name):
    assert difference(spark, connect(SF), REGISTRY[name], oracle.oracle_sql()[name], SF) in ("", "both empty" if name == "action_duplicates" else "")


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the warehouse tables")
def test_entry_has_rows(spark):
    from __spark_entry__ import entry

    assert entry(spark).limit(1).count() == 1
