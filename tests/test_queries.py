from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from cohortlake import workload
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(workload.queries()) == set(workload.oracles())
    assert set(workload.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(workload.queries()))
def test_query_equals_its_oracle(spark, oracle, name):
    outcome, _ = compare(spark, oracle, SF, workload.queries()[name], workload.oracles()[name])
    assert outcome.startswith("ok"), outcome
