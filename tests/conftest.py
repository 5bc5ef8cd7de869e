import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowlog.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="flowlog-tests", shuffle_partitions=4)
    yield s
    s.stop()


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


LOG_SCHEMA = ("case_id string, activity string, timestamp timestamp_ntz, lifecycle string, "
              "event_type string, case_type string, outcome string, resource string, "
              "specialty string, location string, source string")


def make_log(spark, rows):
    """rows: (case, activity, ts-text or None, source, specialty[, resource])."""
    out = []
    for r in rows:
        case, act, t, src, spec = r[:5]
        res = r[5] if len(r) > 5 else None
        out.append((case, act, ts(t) if t else None, "complete", "e", "c", None, res, spec, None, src))
    return spark.createDataFrame(out, LOG_SCHEMA)
