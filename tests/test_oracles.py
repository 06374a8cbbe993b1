"""Every registered query against its SQL on the smallest scale."""

from __future__ import annotations

import pytest

from pricelake.plans.catalog import ORACLES, QUERIES
from tests.conftest import SF_DIR
from tests.oracle import connect, duck_rows, spark_rows, type_mismatches


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    columns, rows = spark_rows(frame)
    assert columns
    if name in ORACLES:
        wanted_columns, wanted = duck_rows(duck, ORACLES[name])
        assert columns == wanted_columns
        assert rows == wanted
        assert type_mismatches(frame, duck, ORACLES[name]) == []
    else:
        assert rows
