"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import re

import pytest

import __spark_entry__ as E
from helpers import same_as_oracle

def _own(names: dict) -> dict:
    """Without the queries of the training-data subpackage, which have tests of their own."""
    return {k: v for k, v in names.items() if not re.match(r"op\d+_|pipeline$", k)}


QUERIES = _own(E.queries())
ORACLE = _own(E.oracle_sql())
SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    same_as_oracle(QUERIES[name](spark, SF), duck, ORACLE[name])


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["epoch_no", "slot_no", "txidx", "inputs", "outputs"]
    assert df.count() > 0
