
from flowlog.functions import (
    combine_date_time, nullify, ok_flag, parse_int, parse_timestamp, respace_datetime,
    salted_sha256, violation_flag, weekday_label,
)
from tests.conftest import ts


def test_ansi_safe_parsing(spark):
    # trap 1: '//', '' and '12.0' give null, no exception under ANSI
    df = spark.createDataFrame([("//",), ("",), ("12.0",), ("7",)], "v string")
    out = df.select(parse_timestamp(nullify("v"), "dd/MM/yyyy HH:mm").alias("t"),
                    parse_timestamp("v").alias("t2"), parse_int("v").alias("i")).collect()
    assert [r.t for r in out] == [None, None, None, None]
    assert [r.i for r in out] == [None, None, None, 7]


def test_combine_date_time_null_time(spark):
    # trap 2: default format -> midnight, explicit format -> null
    df = spark.createDataFrame([("2026-03-05", None)], "d string, t string")
    r = df.select(combine_date_time("d", "t").cast("timestamp_ntz").alias("a"),
                  combine_date_time("d", "t", "yyyy-MM-dd HH:mm:ss").alias("b")).first()
    assert r.a == ts("2026-03-05 00:00:00") and r.b is None


def test_respace(spark):
    # trap 3
    df = spark.createDataFrame([("05/03/202607:08",)], "v string")
    r = df.select(parse_timestamp(respace_datetime("v"), "dd/MM/yyyy HH:mm").cast("timestamp_ntz").alias("t")).first()
    assert r.t == ts("2026-03-05 07:08:00")


def test_flag_polarities(spark):
    # trap 6
    df = spark.createDataFrame([(ts("2026-01-01 10:00:00"), None), (ts("2026-01-02 00:00:00"), ts("2026-01-01 00:00:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    out = df.select(violation_flag("a", "b").alias("v"), ok_flag("a", "b").alias("o")).collect()
    assert (out[0].v, out[0].o) == (False, None)
    assert (out[1].v, out[1].o) == (True, False)


def test_salted_hash(spark):
    # trap 20: null stays null; 123 and 123.0 hash alike; salt matters
    import hashlib
    df = spark.createDataFrame([(None,), ("123",), ("123.0",)], "v string")
    out = [r.h for r in df.select(salted_sha256("v", "s").alias("h")).collect()]
    assert out[0] is None and out[1] == out[2] == hashlib.sha256(b"s.123").hexdigest()
    other = spark.createDataFrame([("123",)], "v string").select(salted_sha256("v", "t").alias("h")).first().h
    assert other != out[1]
    dbl = spark.createDataFrame([(123.0,)], "v double").select(salted_sha256("v", "s").alias("h")).first().h
    assert dbl == out[1]


def test_weekday_label(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00:00"),)], "t timestamp_ntz")  # a Monday
    assert df.select(weekday_label("t").alias("w")).first().w == "Segunda"


def test_text_ids_in_float_notation_stay_apart(spark):
    """Only float columns print numbers in scientific notation; a text id of that form is its own id."""
    from flowlog.functions.hashing import id_text

    text = spark.createDataFrame([("1.0E7",), ("10000000",), ("2.5E3",), ("123.0",)], "v string").select(id_text("v").alias("t"))
    assert [r.t for r in text.collect()] == ["1.0E7", "10000000", "2.5E3", "123"]
    number = spark.createDataFrame([(1.0e7,), (123.0,), (0.5,)], "v double").select(id_text("v").alias("t"))
    assert [r.t for r in number.collect()] == ["10000000", "123", "0.5"]


def test_checkpoint_folder_of_a_session_without_one(spark):
    from flowlog.session import checkpoint_dir

    first = checkpoint_dir(spark)
    assert checkpoint_dir(spark) == first and spark.sparkContext.getCheckpointDir()
