"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

import __spark_entry__ as registry  # noqa: E402
from oracle import compare  # noqa: E402


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, sf, name):
    rows, extra, missing = compare(spark, sf, name)
    assert rows > 0 and not extra and not missing


def test_entry(spark):
    assert registry.entry(spark).columns == ["doc_id", "tags", "indicator_groups"]
