"""Every registered query equals its SQL twin on the smallest tables."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare, connect  # noqa: E402
from tideledger.catalog import load  # noqa: E402

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_matches_sql_twin(spark, con, name):
    ok, text = compare(spark, con, SMALL, name)
    assert ok, text


def test_every_ledger_query_has_a_twin():
    ledger, twins = load()
    assert set(ledger) == set(twins)
    assert set(ledger) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "blockchain", "token", "ref_code", "dr_usd", "avg_twa_balance"]
    assert df.count() > 0
