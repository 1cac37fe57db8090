import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(__file__)]

from tallyspark.schemas import RAW_COLUMNS  # noqa: E402
from tallyspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("tests", 4, **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_rows(spark):
    """Build raw rows from dicts; columns not given are NULL."""

    def build(*rows, loaded_at="2024-01-31 06:00:00"):
        schema = ", ".join(f"{c} string" for c in (*RAW_COLUMNS, "loaded_at")) + ", pos long"
        values = [
            [*[row.get(c) for c in RAW_COLUMNS], row.get("loaded_at", loaded_at), i]
            for i, row in enumerate(rows)
        ]
        df = spark.createDataFrame(values, schema)
        return df.withColumn("loaded_at", df.loaded_at.cast("timestamp_ntz"))

    return build
