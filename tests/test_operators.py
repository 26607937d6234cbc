"""Plan-log operators against plain-Python simulations, capture, and streams."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from planquill.operators import filters, fingerprint, rotation, templates, upsert
from planquill.operators.recursion import reachable
from planquill.plans import all_queries, capture
from planquill.streaming import triggers, windows

T0 = datetime(2024, 1, 1)


def log_rows(seed: int, n: int = 300) -> list[tuple]:
    rng = random.Random(seed)
    return [(i, T0 + timedelta(minutes=rng.randint(0, 3000)), rng.randint(1, 8), rng.randint(1, 5), rng.choice("ab"), rng.randint(1, 90)) for i in range(n)]


SCHEMA = "record_no long, ts timestamp_ntz, query_id long, shape long, app string, record_bytes long"


@pytest.mark.parametrize(("seed", "after"), [(0, False), (1, False), (2, True), (3, True)])
def test_size_rotation_equals_simulation(spark, seed, after):
    rows = log_rows(seed)
    got = {r.record_no: r.file_index for r in rotation.by_size(spark.createDataFrame(rows, SCHEMA), 200, "app", ["ts", "record_no"], after=after).collect()}
    for app in "ab":
        held = index = 0
        for r in sorted((x for x in rows if x[4] == app), key=lambda x: (x[1], x[0])):
            if held >= 200 if after else held > 0 and held + r[5] > 200:
                held, index = 0, index + 1
            held += r[5]
            assert got[r[0]] == index


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_rotation_by_buckets_equals_simulation_with_nulls(spark, seed):
    rng = random.Random(seed)
    rows = [(i, None if rng.random() < 0.05 else t, q, rng.choice([1, 2, 2, 2, None]), rng.choice(["a", "b", None]), b) for i, t, q, _, _, b in log_rows(seed)]
    frame = spark.createDataFrame(rows, SCHEMA)
    order = sorted(rows, key=lambda x: (x[1] is not None, x[1] or T0, x[0]))
    got = {r.record_no: r.file_index for r in rotation.on_change(frame, "shape", "app", ["ts", "record_no"], F.to_date("ts")).collect()}
    assert len(got) == len(rows)
    for app in ("a", "b", None):
        index, before = 0, None
        for r in (x for x in order if x[4] == app):
            index += r[3] is not None and before is not None and r[3] != before
            before = r[3]
            assert got[r[0]] == index
    got = {r.record_no: r.file_index for r in rotation.on_request(frame, F.col("shape") == 1, F.to_date("ts"), ["ts", "record_no"]).collect()}
    index = 0
    for r in order:
        index += r[3] == 1
        assert got[r[0]] == index


@pytest.mark.parametrize(("files", "size"), [(3, 0), (0, 150), (2, 100), (0, 0)])
def test_retention_equals_deleting_oldest_first(spark, files, size):
    rng = random.Random(files + size)
    rows = [("p", f"f{i:02d}", T0 + timedelta(hours=rng.randint(0, 9)), rng.randint(1, 60)) for i in range(12)]
    kept = sorted(rows, key=lambda r: (r[2], r[1]))
    while len(kept) > 1 and ((files and len(kept) > files) or (size and sum(r[3] for r in kept) > size)):
        kept.pop(0)
    df = spark.createDataFrame(rows, "prefix string, path string, mtime timestamp_ntz, bytes long")
    assert {r.path for r in rotation.retained(df, files, size).collect()} == {r[1] for r in kept}


def test_running_total_over_buckets(spark):
    rows = log_rows(5)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.record_no: r.t for r in rotation.running_total(df, F.col("record_bytes"), F.date_trunc("hour", "ts"), ["ts", "record_no"], "t").collect()}
    total = 0
    for r in sorted(rows, key=lambda x: (x[1], x[0])):
        total += r[5]
        assert got[r[0]] == total


@pytest.mark.parametrize("within", [None, ["app"]])
def test_template_modes_equal_simulation(spark, within):
    rows = log_rows(2)
    df = spark.createDataFrame(rows, SCHEMA)
    moded = templates.with_mode(df, ["query_id", "shape"], ["ts", "record_no"], cap=6, within=within)
    got = {r.record_no: (r.template_mode, r.template_id) for r in moded.collect()}
    known: dict = {}
    for r in sorted(rows, key=lambda x: (x[1], x[0])):
        own = known.setdefault(r[4] if within else None, {})
        key = (r[2], r[3])
        if key in own:
            want = ("ref", own[key])
        elif len(own) < 6:
            own[key] = len(own) + 1
            want = ("define", own[key])
        else:
            want = ("none", None)
        assert got[r[0]] == want
    # Renumbered by time, no reference comes before its definition.
    order = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda x: (x[1], x[0])))}
    timed = spark.createDataFrame([(order[k], m, t, next(r[4] for r in rows if r[0] == k)) for k, (m, t) in got.items()], "record_no long, template_mode string, template_id long, app string")
    assert templates.unresolved(timed, within).count() == 0


def test_sampling_follows_the_statement(spark):
    df = spark.range(3000).select((F.col("id") - F.col("id") % 3).alias("top"), "id")
    kept = filters.sampled(df, 0.3, F.col("top"))
    assert kept.groupBy("top").count().where("count != 3").count() == 0 and 600 < kept.count() < 1200
    assert filters.sampled(df, 0, F.col("top")).count() == 0 and filters.sampled(df, 2, F.col("top")).count() == 3000
    assert filters.slow_enough(df, -1, "id").count() == 0 and filters.slow_enough(df, 0, "id").count() == 3000


def test_parameters(spark):
    df = spark.createDataFrame([(["a'b", None, "long value"],)], "v array<string>")
    assert df.select(filters.parameters(F.col("v")).alias("p")).first().p == "$1 = 'a''b', $2 = NULL, $3 = 'long value'"
    assert df.select(filters.parameters(F.col("v"), 4).alias("p")).first().p == "$1 = 'a''b', $2 = NULL, $3 = 'long...'"
    assert df.select(filters.parameters(F.col("v"), 0).alias("p")).first().p is None


def test_shape_hash_tells_shapes(spark):
    nodes = [("a", [], 1), ("a", [0], 9), ("b", [], 1), ("b", [0], 9), ("c", [], 1), ("c", [1], 9), ("d", [], 40), ("d", [0], 9)]
    df = spark.createDataFrame(nodes, "plan string, node_path array<int>, node_code int")
    h = {r.plan: r.shape_hash for r in fingerprint.shape_hash(df, "plan", ["node_code"]).collect()}
    assert h["a"] == h["b"] and len({h["a"], h["c"], h["d"]}) == 3
    assert h["a"] != {r.plan: r.shape_hash for r in fingerprint.shape_hash(df, "plan", ["node_code"], "full").collect()}["a"]


def test_merge_rules_and_nulls(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k long, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k long, v string")
    assert sorted(map(tuple, upsert.insert_on_conflict(t, s, ["k"]).collect()), key=str) == sorted([(1, "a"), (2, "B"), (None, "n"), (3, "C"), (None, "N")], key=str)
    assert ("B" not in [r.v for r in upsert.insert_on_conflict(t, s, ["k"], do_nothing=True).collect()])
    rules = [upsert.When("matched", F.col("s.v") == "B", "nothing"), upsert.When("not matched by source", None, "delete"), upsert.When("not matched", F.col("s.k").isNotNull(), "insert", {"v": F.upper(F.col("s.v"))})]
    assert sorted(map(tuple, upsert.merge(t, s, ["k"], rules).collect())) == [(2, "b"), (3, "C")]
    assert upsert.update(t, F.col("k") > 1, {"v": F.lit("x")}).where("v = 'x'").count() == 1 and upsert.delete(t, F.col("k") > 1).count() == 2


def test_reachable_with_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 5)], "a long, b long")
    assert sorted(r.node for r in reachable(edges, spark.createDataFrame([(1,), (1,)], "node long")).collect()) == [1, 2, 3]


# Capture -------------------------------------------------------------------------------------------

EXPECTED = {
    "w_scan_seq_filter": "Seq Scan", "w_values": "Values Scan", "w_generate_series": "Function Scan", "w_project_set": "ProjectSet", "w_sort_limit": "Limit", "w_agg_cube": "Aggregate", "w_join_hash": "Hash Join",
    "w_join_merge": "Merge Join", "w_join_nested_loop": "Nested Loop", "w_window_row_number": "WindowAgg", "w_union_all": "Append", "w_recursive_sum": "Recursive Union", "w_sample_pct": "Sample Scan",
    "w_incremental_sort": "Sort", "w_setop_intersect": "Aggregate", "w_shape_very_complex": "Hash",
}


def test_captured_nodes(spark, small):
    queries = all_queries()[0]
    names = list(EXPECTED)
    records = capture.captured(spark, [queries[n](spark, small) for n in names])
    assert len(records) == len(names)
    for name, record in zip(names, records, strict=True):
        assert EXPECTED[name] in {n["node_type"] for n in record["nodes"]}, name
        assert [n["node_path"] for n in record["nodes"]] == sorted(n["node_path"] for n in record["nodes"])


def test_capture_settings_and_failure(spark, small):
    queries = all_queries()[0]
    runs = lambda: [queries["w_shape_join_agg"](spark, small) for _ in range(3)]
    modes = [r["template"]["mode"] for r in capture.captured(spark, runs(), capture.Settings(profile="full"))]
    assert modes == ["define", "ref", "ref"]
    assert [r["template"]["mode"] for r in capture.captured(spark, runs(), capture.Settings(max_templates=0))] == ["none"] * 3
    assert not capture.captured(spark, runs(), capture.Settings(min_duration_ms=-1)) and not capture.captured(spark, runs(), capture.Settings(sample_rate=0))

    def broken(_):
        raise OSError("full")

    c = capture.Capture(spark, broken).start()
    for df in runs():
        assert df.count() >= 0
    c.stop()
    assert isinstance(c.failed, OSError)
    first, second = (capture.Capture(spark, lambda _: None).start() for _ in range(2))
    runs()[0].collect()
    first.stop()
    runs()[0].collect()
    second.stop()
    runs()[0].collect()
    assert (first.number, second.number) == (1, 2)


def _one(spark, df, **settings):
    return capture.captured(spark, [df], capture.Settings(**settings))[0]


def test_shapes_tell_expressions_apart(spark):
    """One key, constant, limit or argument makes another shape and query; the same plan built anew does not."""
    a, b = (spark.range(50).selectExpr("id AS x", "id % 7 AS y", "id AS z").repartition(2).alias(n) for n in "ab")
    many = [F.lit(i) for i in range(40)]
    plans = [
        lambda: a.join(b, F.col("a.x") == F.col("b.x")), lambda: a.join(b, F.col("a.x") == F.col("b.y")), lambda: a.join(b, F.col("a.y") == F.col("b.x")), lambda: a.join(b, F.col("a.x") == F.col("b.x"), "left"),
        lambda: a.where("x > 3"), lambda: a.where("x > 4"), lambda: a.groupBy("x").count(), lambda: a.groupBy("y").count(), lambda: a.orderBy("x").limit(3), lambda: a.orderBy("x").limit(4),
        lambda: a.select(F.array("x", *many, F.lit(1))), lambda: a.select(F.array("x", *many, F.lit(2))), lambda: a.select(F.transform(F.array("x"), lambda v: v + 1)),
    ]
    for profile in ("simple", "full"):
        first, second = ([(r["plan_id"], r["query_id"]) for r in capture.captured(spark, [p() for p in plans], capture.Settings(profile=profile))] for _ in range(2))
        assert first == second
        for ids in zip(*first, strict=True):
            assert len(set(ids)) == len(plans) and max(map(abs, ids)) > 2**40


def test_captured_details(spark, small):
    queries = all_queries()[0]
    records = capture.captured(spark, [queries[n](spark, small) for n in EXPECTED], capture.Settings(profile="full", verbose=True))
    by = {name: {(n["node_type"], d["label"]): d["s"] or d["sl"] or d["d"] or d["i"] for n in r["nodes"] for d in n["details"]} for name, r in zip(EXPECTED, records, strict=True)}
    assert len({label for found in by.values() for _, label in found}) >= 20
    assert by["w_join_nested_loop"]["Nested Loop", "Join Filter"] == "(r_regionkey < r_regionkey)"
    assert by["w_sample_pct"]["Sample Scan", "Sampling Parameters"] == ["10.0"] and by["w_sample_pct"]["Sample Scan", "Repeatable Seed"] == "7"
    assert " = " in by["w_join_hash"]["Hash Join", "Hash Cond"] and " = " in by["w_join_merge"]["Merge Join", "Merge Cond"]
    assert "row_number()" in by["w_window_row_number"]["WindowAgg", "Window"]
    for r in records:
        for n in r["nodes"]:
            assert 0 <= n["startup_cost"] <= n["total_cost"] and n["plan_rows"] >= 0 and n["plan_width"] >= 0
        assert not r["flags"] & capture.FLAGS["timing"] and r["flags"] & capture.FLAGS["verbose"]
    scans = [n for n in records[list(EXPECTED).index("w_scan_seq_filter")]["nodes"] if n["node_type"] == "Seq Scan"]
    assert scans and scans[0]["plan_rows"] > 0 and scans[0]["plan_width"] > 0
    plain = _one(spark, queries["w_scan_seq_filter"](spark, small), buffers=False)
    assert all(n["buffers"] is None for n in plain["nodes"]) and not plain["flags"] & capture.FLAGS["buffers"]
    removed = _one(spark, spark.read.parquet(f"{small}/region.parquet").where("r_regionkey >= 2"))
    assert [d["d"] for n in removed["nodes"] for d in n["details"] if d["label"] == "Rows Removed by Filter"] == [2.0]


def test_fast_path_and_context(spark):
    """A plan object that runs again keeps its shape unread, until it is due to be read again."""
    for recheck, hits in ((0, 4), (2, 3)):
        out = []
        c = capture.Capture(spark, out.extend, capture.Settings(profile="full", fast_path_recheck=recheck)).start()
        df = spark.range(9).where("id > 2")
        for _ in range(5):
            df.collect()
        spark.range(9).where("id > 3").collect()
        c.stop()
        assert c.failed is None and c.fast_hits == hits, recheck
        assert [r["template"]["mode"] for r in out] == ["define"] + ["ref"] * 4 + ["define"] and len({r["plan_id"] for r in out}) == 2
    slow = capture.captured(spark, [spark.range(9).where("id > 2")] * 2, capture.Settings(fast_path=False))
    assert slow[0]["plan_id"] == slow[1]["plan_id"]
    ctx, file = slow[0]["ctx"], slow[0]["file"]
    assert ctx["pid"] == os.getpid() and ctx["client_host"] and ctx["auth_user"] and file["pid"] == ctx["pid"] and file["server_start"] < slow[0]["ts"]


# Streams -------------------------------------------------------------------------------------------


def test_streams_equal_batches(spark, small, tmp_path):
    batch = spark.read.parquet(f"{small}/events.parquet")
    batch.withColumn("ts", F.col("ts").cast("timestamp")).repartition(4).write.parquet(str(tmp_path / "in"))
    stored = spark.read.parquet(str(tmp_path / "in"))

    def run(df, name):
        q = df.writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name)

    def stream():
        return spark.readStream.schema(stored.schema).parquet(str(tmp_path / "in"))

    got = run(windows.tumbling(stream(), "1 hour", ["event_type"], late="30 days"), "tumbled")
    want = windows.tumbling(stored, "1 hour", ["event_type"])
    # What the watermark has not passed yet stays open; what came out must be the batch's.
    assert got.exceptAll(want).count() == 0
    assert run(windows.deduplicated(stream(), ["user_id", "event_type"], late="3650 days").select("user_id", "event_type"), "deduplicated").count() == stored.select("user_id", "event_type").distinct().count()
    seen = []
    q = triggers.after_statement(stream(), lambda df, i: seen.extend(map(tuple, triggers.audit(df, "event_type").collect()))).option("checkpointLocation", str(tmp_path / "t")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    total = {}
    for kind, n in seen:
        total[kind] = total.get(kind, 0) + n
    assert total == {r.event_type: r["count"] for r in batch.groupBy("event_type").count().collect()}


def against_sql(spark, duckdb, folder, name):
    """Rows of a query over the events of a folder that its SQL lacks, or the other way."""
    import __spark_entry__ as entry

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    frame = entry.queries()[name](spark, str(folder))
    frame.toPandas().to_parquet(f"{folder}/got.parquet")
    got, want = f"SELECT {', '.join(frame.columns)} FROM '{folder}/got.parquet'", f"SELECT {', '.join(frame.columns)} FROM ({entry.oracle_sql()[name]})"
    return con.execute(f"({got} EXCEPT ALL {want}) UNION ALL ({want} EXCEPT ALL {got})").fetchall()


def test_rotation_by_age_takes_the_nearest_second_and_null_times_last(spark, tmp_path):
    import duckdb

    con, nulls = duckdb.connect(), "CASE WHEN i % 50 = 3 THEN NULL ELSE TIMESTAMP '1969-12-20' + to_microseconds(i * i % 9973 * 21600100 + i * 21600500000 - i % 7 * 500000) END"
    con.execute(f"COPY (SELECT i AS event_id, {nulls} AS ts, i % 3 AS user_id, 'a' || i % 2 AS event_type, 1.5 AS value, '{{\"k\": 1}}' AS props FROM range(400) r(i)) TO '{tmp_path}/events.parquet'")
    assert not against_sql(spark, duckdb, tmp_path, "p_rotate_age")


def test_eligible_templates_have_no_limit_and_null_keys(spark, tmp_path):
    import duckdb

    con = duckdb.connect()
    user, props = "CASE WHEN i % 100000 = 4 THEN NULL ELSE 2 * (i % 1000300) + i % 1000300 % 5 // 4 * 2 + 1 END", "CASE WHEN i % 1000 = 7 THEN NULL ELSE '{\"k\": 1}' END"
    con.execute(f"COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i) AS ts, {user} AS user_id, 'a' AS event_type, 1.5 AS value, {props} AS props FROM range(1300600) r(i)) TO '{tmp_path}/events.parquet'")
    assert not against_sql(spark, duckdb, tmp_path, "p_template_eligible")
