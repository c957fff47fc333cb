import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sigweave.plans.duckdb_sql import ORACLES
from sigweave.plans.reports import REPORTS
from sigweave.plans.streams import STREAMS
from tests.oracle import compare, duck

CORE = {**REPORTS, **STREAMS}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(CORE)
    assert set(CORE) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_import_needs_no_session():
    code = "import __spark_entry__ as e, bench, sigweave.plans.publish; e.queries(); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=sys.path[0] or ".")


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(CORE))
def test_same_rows_as_sql(spark, con, sf_dir, name):
    left, right = compare(spark, con, CORE[name], ORACLES[name], sf_dir)
    assert left == right
