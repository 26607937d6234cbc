"""What the operators share: tables, scratch storage, digests and Arrow helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planquill.runtime import ship

SCRATCH_SETTING = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share, and in it one of this application's own. Only a session on one machine
    may name none; elsewhere a folder of the driver's would lose what executors write."""
    named = spark.conf.get(SCRATCH_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {SCRATCH_SETTING} to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="planquill-")
        spark.sparkContext.setCheckpointDir(named)
    return f"{named}/planquill-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back: lineage ends there, so a
    lost executor costs a re-read and not a recomputation."""
    path = f"{scratch_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._planquill_path = path
    return out


def bucketed(df: DataFrame, keys: list[str], tag: str) -> DataFrame:
    """Like ``stored``, in as many buckets as a shuffle has partitions, each sorted by ``keys``: joins and groupings by
    them read it without a shuffle."""
    spark, n = df.sparkSession, shuffle_partitions(df.sparkSession)
    name = f"planquill_{tag.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{scratch_dir(spark)}/{name}"
    written = df.repartition(n, *keys).sortWithinPartitions(*keys).write.bucketBy(n, *keys).sortBy(*keys)
    written.option("path", path).option("compression", "zstd").saveAsTable(name)
    out = spark.table(name)
    out._planquill_path, out._planquill_table = path, name
    return out


def delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def dropped(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote, once nothing reads it any more."""
    for df in tables:
        if hasattr(df, "_planquill_table"):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._planquill_table}")
        delete(df.sparkSession, df._planquill_path)


def clear(spark: SparkSession) -> None:
    """Delete all scratch tables of this application: for callers that have read their results. Those that
    a returned DataFrame still reads are otherwise left."""
    delete(spark, scratch_dir(spark))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body (and lambdas in it) uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just ``doc_id`` and ``text`` (null: empty), whatever other columns the table has."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def sha(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def key128(c: Column) -> list[Column]:
    """Two independent 64-bit hashes: 128 bits, so that equal keys mean equal values at any size met."""
    return [F.xxhash64(c), F.xxhash64(F.lit("second"), c)]


def batched(schema: str, work: Callable[[dict], Iterator[tuple]], columns: list[str], rows: int = 256) -> Callable:
    """A mapInArrow function that hands ``work`` slices of Python lists by column and turns the
    tuples it yields into Arrow batches of ``schema``. Memory is bound by the slice, not the partition."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = list(work({c: part.column(c).to_pylist() for c in columns}))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*out), arrow, strict=True)], schema=arrow)

    return run
