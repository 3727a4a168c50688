import os
import sys
import time
from datetime import datetime, timezone
from pathlib import Path

import pytest

os.environ["TZ"] = "UTC"
time.tzset()
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from productlens import schemas  # noqa: E402
from productlens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="productlens-tests")
    yield s
    s.stop()


def ts(text: str | None):
    if text is None:
        return None
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def raw_row(event_id, user_id, event_name="page_view", event_time="2024-01-02 10:00:00", feature_name=None,
            session_id="s1", device_type="desktop", country="US", properties_json=None,
            ingested_at="2024-01-03 00:00:00"):
    return (event_id, user_id, event_name, ts(event_time), feature_name, session_id, device_type, country,
            properties_json, ts(ingested_at))


def user_row(user_id, signup_at="2024-01-01 00:00:00", industry="software", company_size="1-10",
             country="US", channel="organic", is_internal=False):
    return (user_id, ts(signup_at), industry, company_size, country, channel, is_internal)


@pytest.fixture()
def make_raw(spark):
    return lambda rows: spark.createDataFrame(rows, schemas.RAW_EVENTS)


@pytest.fixture()
def make_users(spark):
    return lambda rows: spark.createDataFrame(rows, schemas.DIM_USERS)


def by_key(rows, key):
    return {r[key]: r for r in rows}
