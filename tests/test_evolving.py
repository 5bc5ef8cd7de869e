"""Landing folders whose header changes: schema log, reading by name, bounded batches, replay (IO1, IO3-IO6)."""

import gzip
import os
import uuid

from flowlog.session import checkpoint_dir
from flowlog.streaming import evolving as ev
from flowlog.streaming.ingest import IngestSource


def _setup(spark):
    root = os.path.join(checkpoint_dir(spark), "t", uuid.uuid4().hex).removeprefix("file://").removeprefix("file:")
    os.makedirs(os.path.join(root, "landing"))
    return os.path.join(root, "landing"), os.path.join(root, "bronze"), os.path.join(root, "ck")


def _write(land, name, text, encoding="utf-8"):
    with open(os.path.join(land, name), "wb") as fh:
        fh.write(text.encode(encoding))


def _rows(spark, bronze, ck):
    return {r["A"]: r for r in ev.read_evolving(spark, bronze, ck, "t").collect()}


def test_headers_widen_reorder_and_lose_columns(spark):
    land, bronze, ck = _setup(spark)
    src = IngestSource(land, "t")
    _write(land, "1.csv", "A;B\n1;x\n")
    ev.ingest_evolving(spark, src, bronze, ck)
    _write(land, "2.csv", "﻿C;b;A\nz;y;2\n")
    _write(land, "3.csv", "A;D\n3;w\n4\n5;q;extra\n")
    _write(land, "4.csv", "")
    _write(land, "5.csv", "A;E\n")
    with gzip.open(os.path.join(land, "6.csv.gz"), "wt") as fh:
        fh.write("D;A\nzipped;6\n")
    for _ in range(2):      # the second run finds nothing new
        ev.ingest_evolving(spark, src, bronze, ck)
    got = _rows(spark, bronze, ck)
    assert set(got) == {"1", "2", "3", "4", "5", "6"}
    assert {k: (r["B"], r["C"], r["D"], r["E"]) for k, r in got.items()} == {
        "1": ("x", None, None, None), "2": ("y", "z", None, None), "3": (None, None, "w", None), "4": (None, None, None, None),
        "5": (None, None, "q", None), "6": (None, None, "zipped", None)}
    assert {k: r["_rescued_data"] for k, r in got.items() if r["_rescued_data"]} == {"4": "4", "5": "5;q;extra"}
    assert got["2"]["_source_file"].endswith("2.csv") and all(r["_ingestion_timestamp"] for r in got.values())
    assert ev.schema_log(spark, ck, "t").columns()[:2] == ["A", "B"]


def test_batches_are_bounded_and_replays_replace_themselves(spark):
    land, bronze, ck = _setup(spark)
    src = IngestSource(land, "t")
    for i in range(5):
        _write(land, f"{i}.csv", f"A;X{i}\n{i};v\n")
    ev.ingest_evolving(spark, src, bronze, ck, files_per_batch=2)
    batches = sorted(r[0] for r in ev.read_evolving(spark, bronze, ck, "t").select("_batch").distinct().collect())
    assert batches == [0, 1, 2]
    before = ev.schema_log(spark, ck, "t").columns()
    files = [r["_source_file"] for r in ev.read_evolving(spark, bronze, ck, "t").where("_batch = 1").collect()]
    ev.land_batch(spark, files, 1, src, bronze, ck)      # as after a failure between landing and commit
    assert ev.schema_log(spark, ck, "t").columns() == before and len(_rows(spark, bronze, ck)) == 5
    assert ev.read_evolving(spark, bronze, ck, "t").count() == 5


def test_latin1_headers_and_repeated_names(spark):
    land, bronze, ck = _setup(spark)
    _write(land, "1.csv", "A;Situação;situação;\n1;é;ü;w\n", encoding="latin-1")
    ev.ingest_evolving(spark, IngestSource(land, "t", encoding="ISO-8859-1"), bronze, ck)
    row = _rows(spark, bronze, ck)["1"]
    assert (row["Situação"], row["situação2"], row["_c3"]) == ("é", "ü", "w")


def test_table_without_files(spark):
    land, bronze, ck = _setup(spark)
    ev.ingest_evolving(spark, IngestSource(land, "t"), bronze, ck)
    assert ev.read_evolving(spark, bronze, ck, "t").count() == 0
