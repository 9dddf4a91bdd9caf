import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eventide.session import get_session
    s = get_session("local[8]", shuffle_partitions=8)
    yield s


# Fixed fixture values: the reference's sample sensor file (id, epoch
# seconds, temperature) and word-count text, as given in FIXTURES.md.
SENSOR_LINES = [
    "sensor_1,1547718199,35.8",
    "sensor_6,1547718201,15.4",
    "sensor_7,1547718202,6.7",
    "sensor_10,1547718205,38.1",
    "sensor_1,1547718206,32",
    "sensor_1,1547718208,36.2",
    "sensor_1,1547718210,29.7",
    "sensor_1,1547718213,30.9",
    "sensor_1,1547718214,30.9",
    "sensor_1,1547718215,30.9",
    "sensor_1,1547718219,30.9",
    "sensor_1,1547718319,30.9",
]
WORD_LINES = ["hello world", "hello flink", "hello scala", "how are you", "fine thank you", "and you"]


@pytest.fixture(scope="session")
def sensors(spark):
    """Parsed sample readings; ``seq`` is the line number (file order)."""
    from eventide.sources.text import parse_readings
    lines = spark.createDataFrame([(i, s) for i, s in enumerate(SENSOR_LINES)], "seq long, value string")
    return parse_readings(lines, keep=("seq",))
