"""The driver's contract."""

from pathlib import Path

import pytest

DATA = Path("/root/testdata/sf0.001")


def test_names_agree():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not DATA.exists(), reason="no tables")
def test_entry(spark):
    import __spark_entry__ as e

    assert {r["status"] for r in e.entry(spark).collect()} == {"kept", "duplicate", "too_short"}
