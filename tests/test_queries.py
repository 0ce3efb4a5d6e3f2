"""Every registered query of the lake in a session without SESSION_SETTINGS, beside its SQL."""

from __future__ import annotations

import pytest

from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_a_default_session_gives_the_rows_of_the_sql(plain_session, duck, name):
    table = QUERIES[name](plain_session, SF_DIR).toPandas()
    assert not difference(table, duck.execute(ORACLE[name]).df())
