from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(folder))

from quittance.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Apply a column function to a list of texts; gives the list of results."""

    def apply(function, values, schema="i int, x string"):
        from pyspark.sql import functions as F

        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], schema)
        rows = frame.select("i", function(F.col("x")).alias("y")).collect()
        return [row.y for row in sorted(rows, key=lambda row: row.i)]

    return apply
