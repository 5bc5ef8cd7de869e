import pyspark.sql.functions as F

from flowlog.config import SkewConfig
from flowlog.operators import reports as rs
from tests.conftest import ts

COLS = ", ".join(f"c{i} string" for i in range(12))


def _row(file, n, **cells):
    vals = [cells.get(f"c{i}") for i in range(12)]
    return (file, n, *vals)


def _report(spark):
    rows = [
        _row("f", 1, c0="Unidade de Internação 1", c6="UTI"),
        _row("f", 2, c0=" Data: ", c2="01/03/2026"),
        _row("f", 3, c0="", c1="101", c10="08:00:00", c11="INTERNACAO"),
        _row("f", 4, c0="Unidade de Internação 2", c6="ENF"),
        _row("f", 5, c0="", c1="102", c7="09:15:00", c8="ALTA"),
        _row("f", 6, c0="Página 2"),
        _row("f", 7, c0="", c1="103", c8="10:30:00", c9="TRANSFER. DE"),
        _row("f", 8, c0="", c1="104", c5="x"),
        _row("g", 1, c0="", c1="201", c10="07:00:00", c11="ALTA"),
    ]
    return spark.createDataFrame(rows, f"file string, row_no long, {COLS}")


def test_group_headers_carry_down_and_are_not_reset(spark):
    rules = {
        "UNIDADE": (F.col("c0").startswith("Unidade de Internação"), F.col("c6")),
        "DATA": (F.trim(F.col("c0")) == "Data:", F.col("c2")),
    }
    for skew in (SkewConfig(mode="off"), SkewConfig(mode="all", bucket_rows=1)):
        filled = rs.fill_group_headers(_report(spark), rules, skew=skew)
        data = rs.numeric_key_rows(filled, "c1")
        got = {r.c1: (r.UNIDADE, r.DATA) for r in data.collect()}
        # the date is carried across the second unit header; file g has no headers
        assert got == {"101": ("UTI", "01/03/2026"), "102": ("ENF", "01/03/2026"),
                       "103": ("ENF", "01/03/2026"), "104": ("ENF", "01/03/2026"), "201": (None, None)}


def test_layouts_pick_first_match_and_count_drops(spark):
    probes = [("c10", {"ATEND": "c1", "HORA": "c10", "TIPO": "c11"}),
              ("c7", {"ATEND": "c1", "HORA": "c7", "TIPO": "c8"}),
              ("c8", {"ATEND": "c1", "HORA": "c8", "TIPO": "c9"})]
    data = rs.numeric_key_rows(_report(spark), "c1")
    rows, counts = rs.normalise_layouts(data, probes, keep=["file"])
    got = {r.ATEND: (r.layout, r.HORA, r.TIPO) for r in rows.collect()}
    assert got == {"101": (0, "08:00:00", "INTERNACAO"), "102": (1, "09:15:00", "ALTA"),
                   "103": (2, "10:30:00", "TRANSFER. DE"), "201": (0, "07:00:00", "ALTA")}
    assert {r.layout: r.rows for r in counts.collect()} == {0: 2, 1: 1, 2: 1, None: 1}


def test_day_month_repair(spark):
    df = spark.createDataFrame([(ts("2026-05-03 07:00:00"), None), (ts("2026-05-20 07:00:00"), None),
                                (None, "3/5/2026 7:08:09 PM"), (None, "2026-03-05 07:08:09")],
                               "typed timestamp_ntz, text string")
    out = [r.t for r in df.select(rs.repair_timestamp(F.col("typed"), F.col("text"))
                                  .cast("timestamp_ntz").alias("t")).collect()]
    assert out == [ts("2026-03-05 07:00:00"), None, ts("2026-03-05 19:08:09"), ts("2026-03-05 07:08:09")]
