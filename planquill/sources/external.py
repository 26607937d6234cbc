"""Tables that a query reads from outside the data folder, written once for a Spark application."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType, TimestampType

from planquill.plans.registry import Tables
from planquill.runtime import checkpoint_dir
from planquill.sources.model import EPOCH_US, LOG_RECORD

_WRITTEN: dict[tuple[str, str, str], str] = {}


def external(t: Tables, name: str, write: Callable[[str], None]) -> str:
    """The path, in the shared folder, where ``write`` put this table of this data folder."""
    key = (t.spark.sparkContext.applicationId, t.folder, name)
    if key not in _WRITTEN:
        path = f"{checkpoint_dir(t.spark)}/external-{key[0]}/{zlib.crc32(t.folder.encode()):08x}-{name}"
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


#: Where a record cannot do without a word.
WORDS = {"profile": "simple", "mode": "none", "compression": "zstd", "node_type": "Result", "relationship": None}


def records(t: Tables) -> DataFrame:
    """A log record for each nation: its key, name and region as query id, application and process; all else is empty."""
    known = {"query_id": F.col("n_nationkey"), "app": F.col("n_name"), "pid": F.col("n_regionkey"), "node_code": F.lit(1)}

    def column(f: StructField) -> Column:
        if f.name in known:
            out = known[f.name]
        elif isinstance(f.dataType, StructType):
            return F.struct(*[column(x) for x in f.dataType.fields]).alias(f.name)
        elif isinstance(f.dataType, ArrayType):
            out = F.array(column(StructField("node", f.dataType.elementType))) if f.name == "nodes" else F.array()
        elif isinstance(f.dataType, TimestampType):
            out = F.timestamp_seconds(F.lit(EPOCH_US // 1_000_000))
        elif isinstance(f.dataType, StringType):
            out = F.lit(WORDS.get(f.name, ""))
        else:
            out = F.lit(0)
        return out.cast(f.dataType).alias(f.name)

    return t.nation.select(*[column(f) for f in LOG_RECORD.fields])
