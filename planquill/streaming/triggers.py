"""Statement triggers: what a batch of changed rows brings, seen once as a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def audit(new_table: DataFrame, by: str) -> DataFrame:
    """The audit row that a trigger writes for a batch: rows inserted by key."""
    return new_table.groupBy(by).agg(F.count("*").alias("inserted"))


def after_statement(stream: DataFrame, act: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Call ``act`` once for each micro-batch, with its rows as the transition table."""
    return stream.writeStream.foreachBatch(act)
