import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_rows import ODD  # noqa: E402

from station_telemetry.llm.common import prepare  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf(spark):
    prepare(spark)
    return SF


@pytest.fixture(scope="session")
def docs(spark, sf):
    """(doc_id, text) of the smallest documents table."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


@pytest.fixture
def odd(spark, sf):
    rows = [(d, t, "s", "l", 0, 0.5, "row", 1) for d, t in ODD]
    names = "doc_id long, text string, source string, lang string, n_chars long, score double, row string, anchor int"
    return spark.createDataFrame(rows, names)


@pytest.fixture
def labels(spark, sf):
    return spark.createDataFrame(
        [(d, d % 2, (d + 1) % 2) for d, _ in ODD] + [(None, 1, 0), (99, None, None)],
        "doc_id long, quality int, toxic int",
    )
