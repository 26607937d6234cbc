"""The log in its analytic form: plan shapes once, and the measures of each execution.

``split`` makes two tables for Parquet, ``templates`` (a row for each query, shape and profile) and
``executions`` (a row for each record); ``joined`` puts records together again. Shapes are found by a map-side
aggregation, and the join is on (query_id, plan_id, profile).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import model as m

KEY = ["query_id", "plan_id", "profile"]
MEASURES = ["node_flags", "startup_cost", "total_cost", "plan_rows", "plan_width", "startup_us", "total_us", "rows", "loops", "never_executed", "buffers", "wal"]
STATIC = [f.name for f in m.NODE.fields if f.name not in MEASURES and f.name != "details"]


def _details(node: Column, dynamic: bool) -> Column:
    return F.filter(node["details"], lambda d: d["code"].isin(*m.DYNAMIC_DETAILS) if dynamic else ~d["code"].isin(*m.DYNAMIC_DETAILS))


def split(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(templates, executions) of records with complete plans, as ``logfile.read`` gives them."""
    static = F.transform("nodes", lambda n: F.struct(*[n[c].alias(c) for c in STATIC], _details(n, False).alias("details")))
    measured = F.transform("nodes", lambda n: F.struct(*[n[c].alias(c) for c in MEASURES], _details(n, True).alias("details")))
    order = F.struct("ts", "record_no")
    templates = log.withColumn("nodes", static).groupBy(*KEY).agg(F.min_by("nodes", order).alias("nodes"), F.min_by("query_text", order).alias("query_text"), F.min(order).alias("first_seen"))
    return templates, log.withColumn("measures", measured).drop("nodes", "query_text")


def joined(templates: DataFrame, executions: DataFrame) -> DataFrame:
    """Records again: a template's nodes with each execution's measures, static details first."""

    def node(n: Column, x: Column) -> Column:
        parts = [x[f.name] if f.name in MEASURES else F.concat(n["details"], x["details"]) if f.name == "details" else n[f.name] for f in m.NODE.fields]
        return F.struct(*[p.alias(f.name) for p, f in zip(parts, m.NODE.fields, strict=True)])

    both = executions.join(templates.drop("first_seen"), KEY, "left")
    return both.withColumn("nodes", F.zip_with("nodes", "measures", node)).select(*[f.name for f in m.LOG_RECORD.fields])


def node_statistics(executions: DataFrame, templates: DataFrame) -> DataFrame:
    """Rows and loops by shape and place over all executions: read without putting plans together."""
    rows = executions.select(*KEY, F.posexplode("measures").alias("place", "x")).groupBy(*KEY, "place")
    sums = rows.agg(F.count("*").alias("executions"), F.sum("x.rows").alias("rows"), F.sum("x.loops").alias("loops"))
    names = templates.select(*KEY, F.posexplode("nodes").alias("place", "n")).select(*KEY, "place", "n.node_path", "n.node_type", "n.relation")
    return sums.join(names, [*KEY, "place"])
