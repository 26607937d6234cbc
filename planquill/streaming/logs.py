"""Plan logs as streams: rotation with state, and a sink of files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from planquill.runtime import ship


def rotated_by_size(stream: DataFrame, most: int, by: str, order: list[str], size: str = "record_bytes") -> DataFrame:
    """Add ``file_index`` to a stream of records: each writer's state is its file's size and index."""
    ship(stream.sparkSession)
    schema = StructType([*stream.schema.fields, StructField("file_index", LongType())])

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, index = state.get if state.exists else (0, 0)
        rows = pd.concat(list(frames)).sort_values(order)
        out = []
        for n in rows[size].tolist():
            if held > 0 and held + n > most:
                held, index = 0, index + 1
            held += n
            out.append(index)
        state.update((held, index))
        yield rows.assign(file_index=out)

    return stream.groupBy(by).applyInPandasWithState(run, schema, "held long, file_index long", "append", GroupStateTimeout.NoTimeout)


def to_files(stream: DataFrame, path: str, codec: str = "zstd", prefix: str = "planlog") -> DataStreamWriter:
    """Write each micro-batch of records as log files."""
    from planquill.sources.logfile import register

    register(stream.sparkSession)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.format("planlog").option("path", path).option("codec", codec).option("prefix", f"{prefix}-{number:08d}").mode("append").save()

    return stream.writeStream.foreachBatch(write)
