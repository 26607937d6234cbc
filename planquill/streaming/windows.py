"""Windows over the log's time, for batches and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _counted(df: DataFrame, window, by: list[str], late: str | None, ts: str) -> DataFrame:
    d = df.withWatermark(ts, late) if late else df
    out = d.groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def tumbling(df: DataFrame, width: str, by: list[str], ts: str = "ts", late: str | None = None) -> DataFrame:
    """Records in windows that follow each other; ``late`` sets a watermark for streams."""
    return _counted(df, F.window(ts, width), by, late, ts)


def sliding(df: DataFrame, width: str, step: str, by: list[str], ts: str = "ts", late: str | None = None) -> DataFrame:
    return _counted(df, F.window(ts, width, step), by, late, ts)


def sessions(df: DataFrame, gap: str, by: list[str], ts: str = "ts", late: str | None = None) -> DataFrame:
    """Records of a key that follow each other within ``gap``."""
    return _counted(df, F.session_window(ts, gap), by, late, ts)


def deduplicated(df: DataFrame, keys: list[str], ts: str = "ts", late: str | None = None) -> DataFrame:
    """One record for each value of the keys; a stream forgets keys older than its watermark."""
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys) if late else df.dropDuplicates(keys)
