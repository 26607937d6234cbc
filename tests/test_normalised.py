"""The analytic form holds what the log holds."""

from __future__ import annotations

from planquill.plans import all_queries, capture
from planquill.sources import normalised


def test_split_and_join(spark, small, tmp_path):
    queries = all_queries()[0]
    records = capture.captured(spark, [queries[n](spark, small) for n in ("w_shape_join_agg", "w_shape_complex") * 3], capture.Settings(profile="full", omit_text=False))
    log = capture.as_frame(spark, records)
    templates, executions = normalised.split(log)
    templates.write.parquet(str(tmp_path / "templates"))
    executions.write.parquet(str(tmp_path / "executions"))
    templates, executions = spark.read.parquet(str(tmp_path / "templates")), spark.read.parquet(str(tmp_path / "executions"))
    assert templates.count() == 2 and executions.count() == 6
    back = normalised.joined(templates, executions)
    assert back.schema.simpleString() == log.schema.simpleString()

    def plain(df):
        out = []
        for r in df.collect():
            d = r.asDict(recursive=True)
            d["nodes"] = [n | {"details": sorted(n["details"], key=repr)} for n in d["nodes"]]
            d.pop("query_text")  # one text stands for the executions of a shape
            out.append(d)
        return sorted(out, key=lambda d: d["record_no"])

    assert plain(back) == plain(log)
    stats = normalised.node_statistics(executions, templates)
    assert stats.where("executions != 3").count() == 0 and stats.where("node_type = 'Seq Scan'").count() > 0
