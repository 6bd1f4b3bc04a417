import json
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from pulsegrain.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def messages(spark):
    """Texts or documents to a message table, offsets in the order given."""
    def build(values):
        rows = [
            ("k", value if value is None or isinstance(value, str) else json.dumps(value), number)
            for number, value in enumerate(values)
        ]
        return spark.createDataFrame(rows, "key string, value string, offset bigint").selectExpr(
            "key", "value", "timestamp_millis(1700000000000 + offset) as timestamp", "0 as partition", "offset"
        )
    return build


@pytest.fixture
def emitted():
    """Collected output as (topic, tag, document) in message order."""
    def collect(output):
        rows = output.orderBy("offset", "tag", "pos").collect()
        return [(row.topic, row.tag, json.loads(row.value)) for row in rows]
    return collect
