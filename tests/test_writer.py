"""The buffered, rotating writer, its command line, and streams of records."""

from __future__ import annotations

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from planquill.__main__ import main
from planquill.plans import all_queries, capture
from planquill.sources import codec, logfile
from planquill.sources.writer import LogWriter, WriterSettings
from planquill.streaming import logs

from .test_codec import START, _two_nodes, record


def rec(mode="none", template=0):
    return record(_two_nodes(), mode, template, file={"server_start": START})


def read(path):
    return [list(codec.read_log(p.read_bytes(), str(p))) for p in sorted(Path(path).glob("*.plog"))]


def test_buffer_and_flush(tmp_path):
    w = LogWriter(WriterSettings(str(tmp_path), flush_bytes=1 << 20, codec="zstd"))
    w([rec()] * 3)
    assert [len(f) for f in read(tmp_path)] == [0]
    w.flush()
    assert [len(f) for f in read(tmp_path)] == [3]
    w([rec()])
    w.close()
    assert [len(f) for f in read(tmp_path)] == [4]
    now = LogWriter(WriterSettings(str(tmp_path), flush_bytes=0))
    now([rec()])
    assert [len(f) for f in read(tmp_path)] == [4, 1]


def test_rotation_defines_again(tmp_path):
    one = len(codec.record_bytes(rec("define", 1), 0))
    w = LogWriter(WriterSettings(str(tmp_path), codec="none", flush_bytes=0, rotate_bytes=3 * one))
    w([rec("define", 1)] + [rec("ref", 1)] * 40)
    w.rotate()
    w([rec("ref", 1)])
    w.close()
    files = read(tmp_path)
    assert len(files) > 3 and sum(map(len, files)) == 42
    for f in files:
        assert [r["template"]["mode"] for r in f] == ["define"] + ["ref"] * (len(f) - 1)
        assert all(r["nodes"] == _two_nodes() for r in f)


def test_rotation_after_the_fact(tmp_path):
    one = len(codec.record_bytes(rec(), 0))
    w = LogWriter(WriterSettings(str(tmp_path), codec="none", flush_bytes=0, rotate_bytes=2 * one + 1, rotate_after=True))
    w([rec()] * 7)
    w.close()
    assert [len(f) for f in read(tmp_path)] == [3, 3, 1]


def test_age_names_and_retention(tmp_path):
    now = [1_700_000_000.0]
    w = LogWriter(WriterSettings(str(tmp_path), prefix="a", pattern="%Y%m%d%H%M", rotate_seconds=60, keep_files=3, cleanup_seconds=0, flush_bytes=0), clock=lambda: now[0])
    (tmp_path / "b-000000.plog").write_bytes(b"")
    for i in range(8):
        w([rec()])
        os.utime(w.file.name, (now[0], now[0]))
        now[0] += 61
    w.close()
    names = sorted(p.name for p in tmp_path.glob("*.plog"))
    assert names[-1] == "b-000000.plog" and len(names) == 4 and names[0].startswith("a-2023")


def test_retention_by_size_keeps_the_current_file(tmp_path):
    w = LogWriter(WriterSettings(str(tmp_path), keep_bytes=1, cleanup_seconds=0, flush_bytes=0))
    for _ in range(3):
        w([rec()])
        w.rotate()
    w([rec()])
    w.close()
    assert len(list(tmp_path.glob("*.plog"))) == 1


def test_capture_into_files(spark, small, tmp_path):
    queries = all_queries()[0]
    w = LogWriter(WriterSettings(str(tmp_path), codec="zstd", flush_bytes=0))
    c = capture.Capture(spark, w, capture.Settings(profile="full")).start()
    for _ in range(3):
        queries["w_shape_join_agg"](spark, small).collect()
    c.stop()
    w.close()
    assert c.failed is None
    log = logfile.read(spark, str(tmp_path))
    assert [r.mode for r in log.orderBy("record_no").select("template.mode").collect()] == ["define", "ref", "ref"]
    assert log.select("plan_id").distinct().count() == 1


def test_command_line(tmp_path, capsys):
    path = tmp_path / "x.plog"
    path.write_bytes(codec.write_log([rec(), rec("define", 1), rec("ref", 1)], "lz4", {"server_start": START}))
    for form in ("text", "yaml", "xml"):
        assert main(["-f", form, str(path)]) == 0 and "Seq Scan" in capsys.readouterr().out
    assert main(["-f", "json", str(path)]) == 0 and len(json.loads(capsys.readouterr().out)) == 3
    assert main(["--raw", str(path)]) == 0 and len(capsys.readouterr().out.splitlines()) == 3
    assert main(["--server-log", "--log-line-prefix", "%p ", str(path)]) == 0 and capsys.readouterr().out.startswith("70000 LOG:  duration")
    assert main(["--server-log", "--log-line-prefix", "%x ", str(path)]) == 1
    path.write_bytes(b"\0" * 99)
    assert main([str(path)]) == 1 and "magic" in capsys.readouterr().err
    with pytest.raises(SystemExit):
        main(["--raw", "--server-log", str(path)])


def test_streams_of_records(spark, tmp_path):
    rows = [(i, "ab"[i % 2], 10 + i % 7) for i in range(60)]
    spark.createDataFrame(rows, "record_no long, app string, record_bytes long").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("record_no long, app string, record_bytes long").parquet(str(tmp_path / "in"))
    q = logs.rotated_by_size(stream, 50, "app", ["record_no"]).writeStream.outputMode("append").format("memory").queryName("rotated").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.record_no: r.file_index for r in spark.table("rotated").collect()}
    for app in "ab":
        held = index = 0
        for i, a, n in rows:
            if a == app:
                if held > 0 and held + n > 50:
                    held, index = 0, index + 1
                held += n
                assert got[i] == index
    records = [rec() | {"file": {"path": None, "server_start": START, "pid": 1}, "offset": 0, "record_no": i, "plan_id": -5} for i in range(5)]
    capture.as_frame(spark, records).write.parquet(str(tmp_path / "records"))
    source = spark.readStream.schema(logfile.LOG_RECORD).parquet(str(tmp_path / "records"))
    q = logs.to_files(source, str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert logfile.read(spark, str(tmp_path / "out")).where(F.size("nodes") == 2).count() == 5
