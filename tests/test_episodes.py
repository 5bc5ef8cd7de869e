"""Episode links and chains: ties, open stays, gaps at the limit, hot patients."""

import pytest

from flowlog.config import SkewConfig
from flowlog.operators import episodes as ep
from tests.conftest import ts

MODES = [SkewConfig(mode="off"), SkewConfig(mode="all", bucket_rows=2)]
SCHEMA = "patient_id string, stay_id string, kind string, start timestamp_ntz, end timestamp_ntz"


def _stays(spark, rows):
    return spark.createDataFrame([(p, s, {"e": "emergency", "i": "inpatient"}[k], ts(f"2026-01-{a}") if a else None, ts(f"2026-01-{b}") if b else None)
                                  for p, s, k, a, b in rows], SCHEMA)


ROWS = [("p", "e1", "e", "01 08:00", "01 10:00"), ("p", "i2", "i", "01 11:00", "03 09:00"), ("p", "i1", "i", "01 11:00", None),     # a tie: i1
        ("p", "e2", "e", "05 08:00", None), ("p", "i3", "i", "05 09:00", "05 10:00"),       # open, counts as ending at 8:00
        ("p", "e3", "e", "07 08:00", "07 09:00"), ("p", "i4", "i", "07 10:00:01", "07 12:00"),      # a second too late
        ("p", "e4", "e", "09 08:00", "09 20:00"), ("p", "i5", "i", "09 10:00", "09 11:00"),      # overlap: no wait
        ("p", "e5", "e", "11 08:00", "11 08:30"), ("p", "i6", "i", "11 08:00", "11 09:00"),      # the same instant
        ("q", "e6", "e", "01 08:00", "01 10:00"), (None, "e7", "e", "01 08:00", None), ("q", "e8", "e", None, None)]


@pytest.mark.parametrize("skew", MODES)
def test_links(spark, skew):
    got = {r.stay_id: (r.next_stay_id, r.wait_minutes) for r in ep.link_stays(_stays(spark, ROWS), 60, skew).collect()}
    assert got == {"e1": ("i1", 60.0), "e2": ("i3", 60.0), "e3": (None, None), "e4": ("i5", 0.0), "e5": ("i6", 0.0), "e6": (None, None)}


@pytest.mark.parametrize("skew", MODES)
def test_episodes_chain_over_the_longest_reach(spark, skew):
    rows = [("p", "a", "e", "01 00:00", "05 00:00"), ("p", "b", "i", "02 00:00", "02 01:00"), ("p", "c", "i", "05 01:00", "06 00:00"),
            ("p", "d", "e", "06 01:00:01", None), ("p", "f", "i", "06 02:00", "06 03:00"), ("q", "g", "e", "01 00:00", "01 01:00")]
    got = {(r.patient_id, r.episode): (r.stays, r.emergency_stays, r.inpatient_stays, r.last_end) for r in ep.episodes(_stays(spark, rows), 60, skew).collect()}
    assert got == {("p", 1): (3, 1, 2, ts("2026-01-06 00:00")), ("p", 2): (2, 1, 1, None), ("q", 1): (1, 1, 0, ts("2026-01-01 01:00"))}
