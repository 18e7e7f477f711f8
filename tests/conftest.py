import json
import os

import pytest

from clickbasin.functions.dates import ingest_day
from clickbasin.plans.paths import LakePaths
from clickbasin.session import local_session

DAY = ingest_day("2024-03-05")
STAMP = "2024-03-06 02:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    return local_session("4", shuffle_partitions=4, **{"spark.sql.warehouse.dir": str(warehouse)})


@pytest.fixture
def lake(tmp_path):
    return LakePaths(str(tmp_path / "lake"))


@pytest.fixture
def drop_lines():
    """Write lines of JSON (text or objects) as one raw file of an event type and day."""

    def write(root, event_type, lines, day=DAY, name="part-0"):
        folder = f"{root}/event_type={event_type}/{day.folder()}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{name}.txt", "w", encoding="utf-8") as out:
            for line in lines:
                out.write((line if isinstance(line, str) else json.dumps(line)) + "\n")

    return write


def event(event_id, ts="2024-03-05T10:00:00+00:00", user_id="u1", **payload):
    return {"event_id": event_id, "ts": ts, "user_id": user_id, "payload": payload}
