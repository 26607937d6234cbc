"""Log files as DataFrames.

``read`` takes a folder or files on anything that Spark reads: a file is one row of bytes, decoded in
the worker that holds it, as its records refer to earlier ones of the same file. ``PlanLogSource`` is
the same as a registered format, with a writer.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from pyspark.sql.pandas.types import to_arrow_schema

from planquill.runtime import ship

from . import codec
from .model import LOG_RECORD

SUFFIX = ".plog"


def read(spark: SparkSession, path: str | list[str], pattern: str = "*" + SUFFIX, verify: bool = False) -> DataFrame:
    """The records of log files; a broken file fails the query with its path."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")

    arrow = to_arrow_schema(LOG_RECORD)
    names = [f.name for f in LOG_RECORD.fields]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                held = []
                for record in codec.read_log(content.as_py(), name, verify):
                    held.append({k: record.get(k) for k in names})
                    if len(held) >= 512:
                        yield pa.RecordBatch.from_pylist(held, schema=arrow)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return files.mapInArrow(decode, LOG_RECORD)


def nodes(log: DataFrame) -> DataFrame:
    """A row for each plan node, with the record that it is of."""
    return log.select(F.col("file.path").alias("path"), "record_no", "query_id", "plan_id", F.explode("nodes").alias("n")).select("path", "record_no", "query_id", "plan_id", "n.*")


def _plain(value):
    """Rows as dictionaries, all the way down."""
    if hasattr(value, "asDict"):
        return {k: _plain(v) for k, v in value.asDict().items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.verify = options["path"].removeprefix("file://"), options.get("verify", "false") == "true"

    def partitions(self) -> list[InputPartition]:
        if os.path.isdir(self.path):
            return [InputPartition(os.path.join(self.path, f)) for f in sorted(os.listdir(self.path)) if f.endswith(SUFFIX)]
        return [InputPartition(self.path)]

    def read(self, partition: InputPartition):
        with open(partition.value, "rb") as f:
            data = f.read()
        for record in codec.read_log(data, partition.value, self.verify):
            yield tuple(_shaped(record.get(x.name), x.dataType) for x in LOG_RECORD.fields)


def _shaped(value, kind):
    """A dictionary's values in the order of a struct."""
    if value is None:
        return None
    if hasattr(kind, "fields"):
        return tuple(_shaped(value.get(f.name), f.dataType) for f in kind.fields)
    if hasattr(kind, "elementType"):
        return [_shaped(v, kind.elementType) for v in value]
    return value


class _Writer(DataSourceWriter):
    """A file for each task, named when the job commits."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"].removeprefix("file://"), overwrite
        self.codec, self.prefix = options.get("codec", "zstd"), options.get("prefix", "planlog")
        self.frame, self.level, self.job = int(options.get("flushbytes", 1 << 20)), int(options.get("zstdlevel", 1)), uuid.uuid4().hex[:8]

    def write(self, rows) -> WriterCommitMessage:
        records = [_plain(r) for r in rows]
        message = _Message()
        if records:
            os.makedirs(self.path, exist_ok=True)
            message.name = f".{self.prefix}-{self.job}-{uuid.uuid4().hex}.tmp"
            with open(os.path.join(self.path, message.name), "wb") as f:
                f.write(codec.write_log(records, self.codec, records[0].get("file"), self.frame, self.level))
        return message

    def commit(self, messages) -> None:
        names = [x.name for x in messages if x is not None and x.name]
        if self.overwrite and os.path.isdir(self.path):
            for f in os.listdir(self.path):
                if f.endswith(SUFFIX):
                    os.remove(os.path.join(self.path, f))
        for i, name in enumerate(names):
            os.rename(os.path.join(self.path, name), os.path.join(self.path, f"{self.prefix}-{self.job}-{i:06d}{SUFFIX}"))

    def abort(self, messages) -> None:
        for x in messages:
            if x is not None and x.name and os.path.exists(os.path.join(self.path, x.name)):
                os.remove(os.path.join(self.path, x.name))


class _Message(WriterCommitMessage):
    name = ""


class PlanLogSource(DataSource):
    """``spark.read.format("planlog")`` on a folder that driver and executors share."""

    @classmethod
    def name(cls) -> str:
        return "planlog"

    def schema(self):
        return LOG_RECORD

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(PlanLogSource)
