"""Every registered query against its SQL twin on the smallest data set."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check_oracle  # noqa: E402
from ledgerloom.plans import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check_oracle.open_oracle(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    status, note = check_oracle.compare(spark, connection, FOLDER, name)
    assert status in ("ok", "rows"), note


def test_contract():
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = set(entry.queries()) - set(entry.oracle_sql()) - set(entry.LLM_QUERIES)
    assert without == {
        "masking_samples", "card_sample", "sales_forecast", "sales_forecast_by_theme",
    }


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 10
