"""The binary log: round trips over random records, every size class, and broken files."""

from __future__ import annotations

import random
import struct
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from planquill.sources import codec, logfile
from planquill.sources import model as m

START = datetime(2024, 4, 1, tzinfo=timezone.utc)
WIDE = st.sampled_from([0, 1, 0xFF, 0x100, 0xFFFF, 0x10000, 0xFFFFFFFF])
SIGNED = st.sampled_from([0, -1, 127, -128, 128, 32767, 32768, -32769, 2**31 - 1, 2**31, -(2**31) - 1, 2**62])
TEXT = st.one_of(st.none(), st.text(max_size=8), st.just("é" * 300))
FINITE = st.floats(allow_nan=False, allow_infinity=False)


@st.composite
def details(draw):
    out = []
    for _ in range(draw(st.integers(0, 3))):
        kind = draw(st.sampled_from(m.DETAIL_TYPES))
        value = {"string": TEXT, "list": st.lists(TEXT, max_size=3), "double": FINITE, "int": SIGNED, "uint": WIDE, "bool": st.booleans()}[kind]
        out.append(codec.detail(draw(st.integers(1, 65)), kind, draw(value)))
    return out


@st.composite
def plans(draw):
    """Nodes in pre-order, each with its path."""
    out = []

    def node(path):
        has = {k: draw(st.booleans()) for k in ("has_actual", "has_buffers", "has_wal", "never_executed")}
        extra, relation, index = draw(st.booleans()), draw(st.booleans()), draw(st.booleans())
        code = draw(st.integers(1, len(m.NODES)))
        n = {
            "node_path": path, "depth": len(path), "relationship": draw(st.sampled_from(m.RELATIONSHIPS)), "node_code": code, "node_type": m.NODES[code - 1],
            "node_flags": sum(m.NODE_FLAGS[k] for k, on in has.items() if on) | draw(st.sampled_from([0, 1, 2, 64])), "extra_kind": 3 if extra else None, "extra1": draw(WIDE) if extra else None,
            "extra2": draw(WIDE) if extra else None, "startup_cost": draw(FINITE), "total_cost": draw(FINITE), "plan_rows": draw(FINITE), "plan_width": draw(SIGNED),
            "startup_us": draw(SIGNED) if has["has_actual"] else None, "total_us": draw(SIGNED) if has["has_actual"] else None, "rows": draw(FINITE) if has["has_actual"] else None,
            "loops": draw(FINITE) if has["has_actual"] else None, "never_executed": True if has["never_executed"] else None, "buffers": draw(st.lists(SIGNED, min_size=16, max_size=16)) if has["has_buffers"] else None,
            "wal": draw(st.lists(SIGNED, min_size=4, max_size=4)) if has["has_wal"] else None, "relation_oid": draw(WIDE) if relation else None, "relation": draw(TEXT) if relation else None,
            "alias": draw(TEXT) if relation else None, "schema": draw(TEXT) if relation else None, "index_oid": draw(WIDE) if index else None, "index": draw(TEXT) if index else None, "details": draw(details()),
        }
        out.append(n)
        if len(out) < 7:
            for i in range(draw(st.integers(0, 2))):
                node([*path, i])

    node([])
    return out


CTX = {"pid": 70000, "backend_type_id": 4, "backend_type": "client backend", "database_oid": 5, "database": "d", "user_oid": 300, "auth_user": "u", "user": "u", "app": "psql", "client_host": None, "client_port": ""}


def record(nodes, mode="none", template=0, **more):
    return {
        "ts": START + timedelta(milliseconds=86_400_123), "duration_us": 1234567, "profile": "full", "flags": 1 | 8 | 64 | 128, "query_id": -77, "ctx": CTX, "query_text": "select é", "params": None, "details": [],
        "template": {"mode": mode, "id": template, "shape_hash": -5, "metrics": "inline" if mode == "ref" else None}, "nodes": nodes,
    } | more


def both_ways(records, compression="zstd", frame=1 << 20):
    return list(codec.read_log(codec.write_log(records, compression, {"server_start": START}, frame), "p"))


@settings(max_examples=60, deadline=None)
@given(plans(), SIGNED, st.integers(-(2**40), 2**40), details())
def test_round_trip(nodes, duration, delta_ms, own):
    r = record(nodes, duration_us=duration, ts=START + timedelta(milliseconds=delta_ms), details=own)
    (out,) = both_ways([r])
    assert {k: out[k] for k in r} == r and out["plan_id"] == -5 and out["record_no"] == 1


@settings(max_examples=40, deadline=None)
@given(plans())
def test_overlay_law(nodes):
    """A template overlaid with the measures of the plan it was taken from is that plan, but for the order of details."""
    back = codec.overlaid(codec.template_of(nodes), [n | {"details": [d for d in n["details"] if d["code"] in m.DYNAMIC_DETAILS]} for n in nodes])
    by_code = lambda ns: [n | {"details": sorted(n["details"], key=repr)} for n in ns]
    assert by_code(back) == by_code(nodes)


@pytest.mark.parametrize("compression", m.COMPRESSIONS)
@pytest.mark.parametrize("frame", [0, 1 << 20])
def test_templates_and_frames(compression, frame):
    nodes = _two_nodes()
    out = both_ways([record(nodes, "define", 9), record(nodes, "ref", 9, query_text=None, flags=1 | 8)] + [record(nodes, "ref", 9)] * 50, compression, frame)
    assert [o["nodes"] for o in out] == [nodes] * 52 and {o["query_id"] for o in out} == {-77}
    assert [o["template"]["mode"] for o in out[:2]] == ["define", "ref"] and out[-1]["record_no"] == 52


def _two_nodes():
    base = {
        "relationship": None, "node_flags": 4, "extra_kind": None, "extra1": None, "extra2": None, "startup_cost": 0.0, "total_cost": 1.5, "plan_rows": 10.0, "plan_width": 8, "startup_us": 1, "total_us": 20,
        "rows": 3.0, "loops": 1.0, "never_executed": None, "buffers": None, "wal": None, "relation_oid": None, "relation": None, "alias": None, "schema": None, "index_oid": None, "index": None,
    }
    top = base | {"node_path": [], "depth": 0, "node_code": 31, "node_type": "Sort", "details": [codec.detail(10, "list", ["a"]), codec.detail(25, "list", ["-1", "quicksort", "Memory", "25"])]}
    return [top, base | {"node_path": [0], "depth": 1, "relationship": "Outer", "node_code": 9, "node_type": "Seq Scan", "relation_oid": 7, "relation": "t", "details": [codec.detail(21, "uint", 5)]}]


def test_broken_files():
    good = codec.write_log([record(_two_nodes())], "none", {"server_start": START})
    for bad, why in (
        (b"\0" * 4 + good[4:], "magic"), (good[:-5], "ends"), (good[:4] + struct.pack("<H", 99) + good[6:], "version"), (b"", "magic"), (good[:20], "ends"),
        (codec.write_log([record([], "ref", 3)], "none", {"server_start": START}), "before it is defined"), (good[:8] + struct.pack("<H", 9) + good[10:], "compression"),
    ):
        with pytest.raises(codec.LogError, match=why):
            list(codec.read_log(bad, "p"))
    raw = codec.record_bytes(record(_two_nodes()), codec._server_us(START))
    longer = bytearray(raw[:1]) + struct.pack("<H", len(raw) - 3 + 2) + raw[3:] + b"\0\0"
    with pytest.raises(codec.LogError, match="left over"):
        list(codec.read_log(good[:40] + bytes(longer), "p"))
    with pytest.raises(codec.LogError, match="sums"):
        list(codec.read_log(good, "p", verify=True))
    for cut in range(45, len(good) - 1, 7):
        with pytest.raises(codec.LogError):
            list(codec.read_log(good[:cut], "p"))


def test_unknown_names():
    assert codec.detail(99, "int", 1)["label"] == "Detail 99" and codec.node_name(77) == "T_77"
    assert codec.node_name(331, 13) == "Result" and codec.node_name(358, 13) == "Merge Join" and codec.node_name(373, 13) == "Limit" and codec.node_name(357, 13) == "T_357"
    assert codec.crc32c(b"123456789") == 0xE3069283


def test_version_3():
    """One record of the oldest form, written by hand."""
    text = lambda s: struct.pack("<I", 0xFFFFFFFF) if s is None else struct.pack("<I", len(s)) + s.encode()
    node = struct.pack("<BHHBII", 0, 339, 4, 0, 0, 0) + struct.pack("<dddi", 0, 1, 2, 8) + struct.pack("<qqdd", 10, 20, 3.0, 1.0)
    node += struct.pack("<B", 1) + struct.pack("<I", 7) + text("t") + text(None) + struct.pack("<H", 0) + struct.pack("<I", 0)
    payload = struct.pack("<IHHIqQ", m.PAYLOAD_MAGIC, 3, 0, 1, 1500, 42) + struct.pack("<qqq", 5_000_000, 0, 0) + struct.pack("<II", 11, 4) + text("client backend") + struct.pack("<I", 5) + text("d")
    payload += struct.pack("<I", 10) + text("u") + text("u") + text("app") + text(None) + text(None) + struct.pack("<BIQ", 0, 0, 9) + text("select 1") + text(None) + node
    head = struct.pack("<IHHIqI", m.FILE_MAGIC, 3, 24, 170000, 0, 0)
    one = struct.pack("<IHHHHIQqIIIIIIQq", m.RECORD_MAGIC, 3, 72, 0, 1, 1, 1, 5_000_000, 11, 5, 10, len(payload), len(payload), codec.crc32c(payload), 42, 1500)
    (r,) = codec.read_log(head + one + payload, "old", verify=True)
    assert r["nodes"][0]["node_type"] == "Seq Scan" and r["query_text"] == "select 1" and r["query_id"] == 42 and r["nodes"][0]["rows"] == 3.0 and r["plan_id"] == 9
    with pytest.raises(codec.LogError, match="check sum"):
        list(codec.read_log(head + one + payload[:-1] + b"\1", "old", verify=True))


def test_data_source(spark, tmp_path):
    from planquill.plans.capture import as_frame

    rng = random.Random(1)
    records = [record(_two_nodes(), file={"path": None, "server_start": START, "pid": 1}, offset=0, record_no=i, plan_id=-5, duration_us=rng.randint(1, 10**6)) for i in range(20)]
    logfile.register(spark)
    df = as_frame(spark, records)
    for kind in m.COMPRESSIONS:
        folder = str(tmp_path / kind)
        df.repartition(3).write.format("planlog").option("path", folder).option("codec", kind).mode("append").save()
        a, b = spark.read.format("planlog").load(folder), logfile.read(spark, folder)
        assert a.schema == b.schema == df.schema
        want = sorted(r["duration_us"] for r in records)
        assert sorted(r.duration_us for r in a.collect()) == sorted(r.duration_us for r in b.collect()) == want
        assert logfile.nodes(b).where("node_type = 'Seq Scan' AND relation = 't'").count() == 20
    df.limit(2).write.format("planlog").option("path", str(tmp_path / "none")).mode("overwrite").save()
    assert logfile.read(spark, str(tmp_path / "none")).count() == 2
