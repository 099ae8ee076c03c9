"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

from checks.compare import database, difference
from checks.registry import ORACLES, QUERIES
from tests.conftest import SF

INVENTORY = {
    "src": 4, "sel": 8, "txt": 5, "fld": 8, "wrk": 8, "edu": 1, "skl": 3, "agg": 11, "sim": 3, "sto": 8, "str": 3,
}

# fewer than 20 users at this size; the larger size has rows
EMPTY_AT_THIS_SIZE = {"sel4_skip_limit"}


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_inventory_is_complete():
    counts = {}
    for name in QUERIES:
        counts[name[:3]] = counts.get(name[:3], 0) + 1
    assert counts == INVENTORY and set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    found = difference(spark, con, name, SF)
    assert found == ("both empty" if name in EMPTY_AT_THIS_SIZE else "")
