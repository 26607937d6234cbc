"""Summaries of logs and of benchmark runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latency(log: DataFrame, by: list[str]) -> DataFrame:
    """Records, mean, largest and 95th-percentile duration."""
    return log.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg("duration_ms"), 6).alias("mean_ms"), F.max("duration_ms").alias("max_ms"), F.round(F.percentile("duration_ms", 0.95), 6).alias("p95_ms"))


def bench_summary(runs: DataFrame) -> DataFrame:
    """Mean and sample deviation (0 for one run) by workload and scenario."""
    return runs.groupBy("workload", "scenario").agg(
        F.count("*").alias("runs"), F.round(F.avg("tps"), 6).alias("tps"), F.round(F.coalesce(F.stddev_samp("tps"), F.lit(0.0)), 6).alias("tps_dev"),
        F.round(F.avg("latency_ms"), 6).alias("latency_ms"), F.round(F.avg("bytes"), 6).alias("bytes"),
        F.round(F.avg(F.when(F.col("tx") != 0, F.col("bytes") / F.col("tx"))), 6).alias("bytes_per_tx"),
    )


def overhead(summary: DataFrame, baseline: str = "baseline") -> DataFrame:
    """Throughput lost against the workload's baseline, in percent; a row for each workload is joined."""
    base = summary.where(F.col("scenario") == baseline).select("workload", F.col("tps").alias("base"))
    return summary.join(base, "workload", "left").withColumn("overhead_pct", F.round(100 * (F.col("base") - F.col("tps")) / F.col("base"), 6)).drop("base")


def merged_workers(stats: DataFrame, node: list[str]) -> DataFrame:
    """What workers report of a node, merged by worker (-1 is the leader) and listed in their order."""
    one = stats.groupBy(*node, "worker").agg(F.sum("rows").alias("rows"), F.sum("loops").alias("loops"), F.max("time_us").alias("time_us"))
    return one.groupBy(*node).agg(F.sort_array(F.collect_list(F.struct("worker", "rows", "loops", "time_us"))).alias("workers"))
