import os
import uuid

import pytest

from flowlog.config import LOG_COLUMNS
from flowlog.operators.eventlog import mining_view, with_case_duration
from flowlog.plans import sample_logs
from flowlog.session import checkpoint_dir
from flowlog.sources.files import read_delimited, write_delimited
from flowlog.sources.xes import export_xes, read_xes
from flowlog.streaming.ingest import IngestSource, ingest_all, ingest_to_bronze, read_bronze
from tests.conftest import SF001, make_log


def _root(spark):
    return os.path.join(checkpoint_dir(spark), "t", uuid.uuid4().hex)


def _write(path, name, text, encoding="utf-8"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding=encoding) as fh:
        fh.write(text)


def test_ingest_rescues_bad_lines_and_is_exactly_once(spark):
    # trap 22 and IO6
    root = _root(spark)
    land = os.path.join(root, "landing", "t")
    _write(land, "a.csv", "A;B;C\n1;x;y\n2;short\n3;a;b;extra\n")
    src = IngestSource(folder=land, table="t")
    ingest_to_bronze(spark, src, os.path.join(root, "bronze"), os.path.join(root, "ck"))
    ingest_to_bronze(spark, src, os.path.join(root, "bronze"), os.path.join(root, "ck"))
    b = read_bronze(spark, os.path.join(root, "bronze"), "t")
    rows = {r.A: r for r in b.collect()}
    assert len(rows) == 3
    assert rows["1"]._rescued_data is None
    assert rows["2"]._rescued_data == "2;short" and rows["3"]._rescued_data == "3;a;b;extra"
    assert rows["1"]._source_file.endswith("a.csv") and rows["1"]._ingestion_timestamp is not None
    # a new file is picked up, old ones are not re-read
    _write(land, "b.csv", "A;B;C\n4;p;q\n")
    ingest_all(spark, [src], os.path.join(root, "bronze"), os.path.join(root, "ck"))
    assert read_bronze(spark, os.path.join(root, "bronze"), "t").count() == 4


def test_schema_evolution_merges_on_read(spark):
    # IO5: a later export gains a column; the stream restarts on the same checkpoint
    # with the wider declared header, older files are not re-read, readers merge schemas
    root = _root(spark)
    land = os.path.join(root, "landing")
    bronze, ck = os.path.join(root, "bronze"), os.path.join(root, "ck")
    _write(land, "a.csv", "A;B\n1;x\n")
    ingest_to_bronze(spark, IngestSource(land, "t", columns=("A", "B")), bronze, ck)
    _write(land, "b.csv", "A;B;C\n2;y;z\n")
    ingest_to_bronze(spark, IngestSource(land, "t", columns=("A", "B", "C")), bronze, ck)
    b = read_bronze(spark, bronze, "t")
    assert "C" in b.columns
    got = {r.A: r.C for r in b.collect()}
    assert got == {"1": None, "2": "z"}


def test_latin1_round_trip(spark):
    # IO9 / IO10
    root = _root(spark)
    _write(root, "x.csv", "NOME;UNIDADE\nJoão;1º Andar\n", encoding="latin-1")
    df = read_delimited(spark, root, encoding="ISO-8859-1")
    assert df.first().NOME == "João"
    out = os.path.join(_root(spark), "out")
    write_delimited(df, out)
    assert read_delimited(spark, out).first().UNIDADE == "1º Andar"


def test_xes_round_trip_is_lossless(spark):
    log = with_case_duration(sample_logs.order_log(spark, SF001))
    path = os.path.join(_root(spark), "xes")
    export_xes(log, path)
    back = read_xes(spark, path)
    orig = mining_view(log).select(*LOG_COLUMNS)
    assert back.columns == LOG_COLUMNS
    assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0
    months = [d for d in os.listdir(path) if d.startswith("month=")]
    assert len(months) > 12


def test_xes_traces_are_lines_that_split(spark):
    # one line a trace, so a file is read by many tasks; line breaks and markup in values survive
    odd = ["a\nb", "a\r\nb", "tab\tend", "<x a='1'>&amp;\"", "]]>", "line\u2028sep\u0085", "</trace>", "<log x", ""]
    log = make_log(spark, [(f"c{i}{v}", v, f"2024-01-0{1 + i % 9} 10:00:00", v, v) for i, v in enumerate(odd)]
                   + [("c0", "later", "2024-02-01 10:00:00", "s", None)])
    path = os.path.join(_root(spark), "xes")
    export_xes(log, path, single_file=True)
    lines = [r.value for r in spark.read.option("lineSep", "\n").text(path).collect()]
    assert sum(x.startswith("<trace>") and x.endswith("</trace>") for x in lines) == len(odd) + 1
    columns = ["case_id", "activity", "source", "specialty", "timestamp"]
    want = sorted(map(str, log.select(*columns).collect()))
    assert sorted(map(str, read_xes(spark, path).select(*columns).collect())) == want
    assert sorted(map(str, read_xes(spark, path, trace_per_line=False).select(*columns).collect())) == want
    with_parts = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        split = read_xes(spark, path)
        assert split.rdd.getNumPartitions() > len([f for f in spark.read.text(path).inputFiles()])
        assert sorted(map(str, split.select(*columns).collect())) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", with_parts)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_xes_over_several_lines_is_read_by_file_and_fails_by_line(spark):
    path = os.path.join(_root(spark), "xes")
    _write(os.path.join(path, "month=2024-01"), "a.xml", """<?xml version="1.0"?>
<log>
  <trace>
    <string key="concept:name" value="c1"/>
    <event><string key="concept:name" value="A"/><string key="source" value="s"/>
      <date key="time:timestamp" value="2024-01-01T00:00:00.000000Z"/></event>
  </trace>
</log>
""")
    assert [(r.case_id, r.activity, r.source) for r in read_xes(spark, path, trace_per_line=False).collect()] == [("c1", "A", "s")]
    with pytest.raises(Exception, match="not a whole trace"):
        read_xes(spark, path).collect()
