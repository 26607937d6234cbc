"""Rotation and retention of log files.

Greedy rotation is a sequential fold over each writer's stream. Streams are hashed to partitions and
sorted there, and the fold holds one number a stream; rows pass through in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from planquill.runtime import ship


def _fold(log: DataFrame, stream: str, order: list[str], measure: str, limit: float, by_age: bool = False, after: bool = False) -> DataFrame:
    ship(log.sparkSession)
    schema = StructType([*log.schema.fields, StructField("file_index", LongType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, index = None, 0, 0
        for frame in frames:
            out = []
            for s, x in zip(frame[stream].tolist(), frame[measure].tolist(), strict=True):
                if s != now:
                    now, held, index = s, (x if by_age else 0), 0
                    first = True
                else:
                    first = False
                if by_age:
                    if not first and x - held > limit:
                        index, held = index + 1, x
                else:
                    if held > 0 and (held >= limit if after else held + x > limit):
                        index, held = index + 1, 0
                    held += x
                out.append(index)
            yield frame.assign(file_index=out)

    # Null times come last, as in the SQL: first in its file, one would leave the file without an age.
    sorted_ = log.repartition(stream).sortWithinPartitions(stream, *[F.col(o).asc_nulls_last() for o in order])
    return sorted_.mapInPandas(run, schema)


def by_size(log: DataFrame, most: int, stream: str, order: list[str], size: str = "record_bytes", after: bool = False) -> DataFrame:
    """Before a record that would make a non-empty file larger than ``most``, a new file begins; ``after`` the fact: the
    record that brings a file to ``most`` is its last."""
    return _fold(log, stream, order, size, most, after=after)


def by_age(log: DataFrame, most_seconds: float, stream: str, order: list[str], seconds: str) -> DataFrame:
    """A record more than ``most_seconds`` after the first of its file begins a new one."""
    return _fold(log, stream, order, seconds, most_seconds, by_age=True)


def _matched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join on ``keys`` in which nulls meet, keeping the left side's keys."""
    other = right.withColumnsRenamed({k: f"_r{i}" for i, k in enumerate(keys)})
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_r{i}"))
    return left.join(other, on).drop(*[f"_r{i}" for i in range(len(keys))])


def running_total(df: DataFrame, value: Column, bucket: Column, order: list[str], name: str, within: list[str] | None = None) -> DataFrame:
    """Running sum in an order, by buckets of it: sums within buckets, shifted by what earlier buckets
    hold. Only a row for each bucket meets in one task. Null buckets and streams are ones of their own, nulls first."""
    within = within or []
    d = df.withColumns({"_b": bucket, "_v": value})
    before = Window.partitionBy(*within).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = d.groupBy(*within, "_b").agg(F.sum("_v").alias("_s")).select(*within, "_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*within, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    both = _matched(d.withColumn("_in", F.sum("_v").over(inside)), sums, [*within, "_b"])
    return both.withColumn(name, F.col("_in") + F.col("_shift")).drop("_b", "_v", "_in", "_shift")


def on_request(log: DataFrame, requested: Column, bucket: Column, order: list[str]) -> DataFrame:
    """Each request begins a new file with the record that carries it; a null is no request."""
    return running_total(log, F.when(requested, 1).otherwise(0), bucket, order, "file_index")


def on_change(log: DataFrame, setting: str, stream: str, order: list[str], bucket: Column) -> DataFrame:
    """A changed setting begins a new file; a null is no change. A bucket's first record is held against the last setting
    of the bucket before it, so no task meets more of a stream than a bucket."""
    d = log.withColumn("_p", bucket)
    last = d.groupBy(stream, "_p").agg(F.max_by(setting, F.struct(*order)).alias("_last"))
    ends = last.select(stream, "_p", F.lag("_last").over(Window.partitionBy(stream).orderBy("_p")).alias("_end"))
    inside = Window.partitionBy(stream, "_p").orderBy(*order)
    d = _matched(d, ends, [stream, "_p"])
    before = F.when(F.row_number().over(inside) == 1, F.col("_end")).otherwise(F.lag(setting).over(inside))
    d = d.withColumn("_c", F.coalesce(F.col(setting) != before, F.lit(False)).cast("long"))
    return running_total(d, F.col("_c"), F.col("_p"), order, "file_index", [stream]).drop("_p", "_end", "_c")


def file_name(prefix: Column, ts: Column, pattern: str, pid: Column, index: Column) -> Column:
    """``prefix-time-pid-index.plog``."""
    return F.concat_ws("-", prefix, F.date_format(ts, pattern), pid.cast("string"), F.concat(F.format_string("%06d", index.cast("int")), F.lit(".plog")))


def retained(files: DataFrame, most_files: int = 0, most_bytes: int = 0, prefix: str = "prefix") -> DataFrame:
    """(prefix, path, mtime, bytes): what stays when oldest files go first while either limit is exceeded (0: no
    limit). The newest file always stays. Counting from the newest, a file goes once a limit is passed."""
    newest = Window.partitionBy(prefix).orderBy(F.col("mtime").desc(), F.col("path").desc())
    d = files.withColumn("_n", F.row_number().over(newest)).withColumn("_sum", F.sum("bytes").over(newest.rowsBetween(Window.unboundedPreceding, 0)))
    keep = F.lit(True)
    if most_files > 0:
        keep = keep & (F.col("_n") <= most_files)
    if most_bytes > 0:
        keep = keep & (F.col("_sum") <= most_bytes)
    return d.where(keep | (F.col("_n") == 1)).drop("_n", "_sum")
