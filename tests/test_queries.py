"""Every registered query against its check SQL, on the smallest tables."""

import os

import pytest

from oracle import compare, duck
from vacantia.workloads import CHECKS, QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    status, _, detail = compare(spark, con, FOLDER, name)
    assert status in ("ok", "rows"), detail


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(QUERIES)
    banned = ("pipeline",)
    assert not [n for n in QUERIES if n.startswith(banned)]
