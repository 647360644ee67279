"""Every registered query against its SQL at the smallest scale, and the driver contract."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from statlake.queries import ORACLES, QUERIES  # noqa: E402
from tools.check import compare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(
    not pathlib.Path(SF_DIR).exists(), reason="test tables are not here"
)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    assert name in ORACLES
    diff, rows, _ = compare(spark, SF_DIR, name)
    assert diff is None
    assert rows > 0


def test_driver_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert "value_numeric" in contract.entry(spark).columns
