import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fieldpulse import build_session  # noqa: E402
from fieldpulse.schemas import READING_REQUEST  # noqa: E402
from telemetry_rows import at  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def deliveries(spark):
    """Builds deliveries from (key, recorded, ingested, value[, device[, metric]]), in order of arrival."""
    def build(*rows):
        full = []
        for seq, (key, recorded, ingested, value, *rest) in enumerate(rows):
            device = rest[0] if rest else "d1"
            metric = rest[1] if len(rest) > 1 else "temperature"
            full.append((device, metric, value, recorded and at(recorded), key, at(ingested), seq))
        return spark.createDataFrame(full, READING_REQUEST)
    return build


@pytest.fixture
def devices(spark):
    def build(*ids):
        return spark.createDataFrame([(i,) for i in ids], "id string")
    return build
