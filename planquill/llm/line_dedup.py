"""Line deduplication over levelled sorted runs of line hashes.

A line's key is its text without white space at either end, A-Z in lower case; keys are held as 128-bit
hashes. Documents come in batches. A batch's keys are counted by document; those that a run has
already settled (found in ``min_docs`` documents) are anti-joined away, and the rest is written as a
new run. Runs are bucketed and sorted by key, so that these joins and the merges are merge joins
without a shuffle; when a level has ``FANOUT`` runs they are compacted into one run of the next
level, counts summed. What the runs together count at ``min_docs`` or more is dropped everywhere. Runs kept in a folder
meet the batches of later sessions.

Everything here is DataFrame functions; only keys are shuffled, and the texts once, to meet the
places of their dropped lines. Frequent keys are broadcast where there are at most
``BROADCAST_KEYS`` (16 bytes each), else joined by shuffle with skew splitting.

Defined results: null and empty text is one empty line; empty keys are never dropped; a row is a
document, repeated or not; null ids pass through; an empty table gives an empty result; other columns are
kept, columns named like the two counts are replaced.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import delete, key128, scratch_dir, shuffle_partitions, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"
MIN_DOCS = 10
BATCHES = 4
FANOUT = 2
BROADCAST_KEYS = 500_000


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(BLANKS))
    # Without a character beyond ASCII, lower() changes A-Z only, and faster.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


class LineRuns:
    """Sorted runs of (h1, h2, n): in how many documents of the batches so far a key was found.

    Runs live in ``folder`` and are bucketed tables there; ``manifest-<n>`` names those that count, level by level, and is
    named when it is whole: a batch that fails leaves the runs as they were. Opening a folder again finds them; one session writes
    at a time. Without a folder they are scratch and ``forget`` drops them."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT, folder: str | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.folder = (folder or f"{scratch_dir(spark)}/line-runs-{uuid.uuid4().hex}").rstrip("/")
        self.buckets = shuffle_partitions(spark)
        self.levels: list[list[str]] = []
        self.made: set[str] = set()
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if manifests := self._manifests():
            text = spark.read.text(f"{self.folder}/{manifests[-1]}").first()["value"]
            self.buckets, self.levels = (json.loads(text)[x] for x in ("buckets", "levels"))
            for name in self.runs:
                self._register(name)

    def _manifests(self) -> list[str]:
        there = self._fs.listStatus(self._path(self.folder)) if self._fs.exists(self._path(self.folder)) else []
        return sorted(n for n in (s.getPath().getName() for s in there) if n.startswith("manifest-"))

    def _register(self, name: str) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (h1 BIGINT, h2 BIGINT, n BIGINT) USING parquet "
            f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{name}'"
        )
        self.made.add(name)

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            df.repartition(self.buckets, "h1", "h2").sortWithinPartitions("h1", "h2").write
            .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
            .option("path", f"{self.folder}/{name}").option("compression", "zstd").saveAsTable(name)
        )
        self.made.add(name)
        return name

    def _commit(self, gone: list[str]) -> None:
        """Name the runs that count from now on; then those that they replace go."""
        old = self._manifests()
        number = int(old[-1].rsplit("-", 1)[1]) + 1 if old else 0
        draft, final = self._path(f"{self.folder}/draft-{uuid.uuid4().hex}"), self._path(f"{self.folder}/manifest-{number:08}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps({"buckets": self.buckets, "levels": self.levels}).encode()))
        out.close()
        if not self._fs.rename(draft, final):
            raise OSError(f"{final.toString()} could not be named")
        for name in gone:
            self._delete(name)
        for name in old:
            delete(self.spark, f"{self.folder}/{name}")

    def _delete(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(self.spark, f"{self.folder}/{name}")
        self.made.discard(name)

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs merged by key, counts summed. By outer merge joins: a grouping over a union of bucketed tables is planned
        without a shuffle, and then does not always bring equal keys together."""
        every = self.spark.createDataFrame([], "h1 long, h2 long, n long")
        for name in names:
            run = self.spark.table(name)
            if name == names[0]:
                every = run
            else:
                both = every.join(run.withColumnRenamed("n", "m").hint("merge"), ["h1", "h2"], "full_outer")
                every = both.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
        return every

    @property
    def runs(self) -> list[str]:
        return [n for level in self.levels for n in level]

    def add(self, keys: DataFrame) -> None:
        """Take in a batch: (h1, h2), a row for each document that has the key."""
        counts = keys.groupBy("h1", "h2").agg(F.count("*").alias("n"))
        for name in self.runs:
            settled = self.spark.table(name).where(F.col("n") >= self.min_docs).select("h1", "h2")
            counts = counts.join(settled.hint("merge"), ["h1", "h2"], "left_anti")
        gone: list[str] = []
        self._place(0, self._write(counts), gone)
        self._commit(gone)

    def _place(self, level: int, name: str, gone: list[str]) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            names, self.levels[level] = self.levels[level], []
            gone.extend(names)
            self._place(level + 1, self._write(self._merged(names)), gone)

    def frequent(self) -> DataFrame:
        """(h1, h2) of the keys found in ``min_docs`` documents or more."""
        return stored(self._merged(self.runs).where(F.col("n") >= self.min_docs).select("h1", "h2"), "frequent-lines")

    def forget(self) -> None:
        """Drop the runs and their files."""
        for name in list(self.made):
            self._delete(name)
        delete(self.spark, self.folder)
        self.levels = []


def keyed_lines(docs: DataFrame, id_col: str, text: Column, batches: int) -> DataFrame:
    """A row for each line with a key: document (id and text key), place, key, and whether the key stands
    there first in its row; written by batch."""
    a, b = key128(text)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), a.alias("d1"), b.alias("d2"), F.transform(F.split(text, "\n", -1), line_key).alias("keys"))

    def place(k: Column, i: Column) -> Column:
        h1, h2 = key128(k)
        return F.when(F.length(k) >= 1, F.struct(h1.alias("h1"), h2.alias("h2"), i.alias("pos")))

    d = d.withColumn("keys", F.array_sort(F.filter(F.transform("keys", place), lambda x: x.isNotNull())))

    def first(x: Column, i: Column) -> Column:
        before = F.get("keys", i - 1)
        return F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["pos"].alias("pos"), F.coalesce((before["h1"] != x["h1"]) | (before["h2"] != x["h2"]), F.lit(True)).alias("first"))

    d = d.select("doc_id", "d1", "d2", F.explode(F.transform("keys", first)).alias("x")).select("doc_id", "d1", "d2", "x.*")
    return d.withColumn("batch", F.pmod(F.xxhash64("doc_id", "d1"), F.lit(batches)).cast("int"))


def drop_frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text", lines_col: str = "n_lines", dropped_col: str = "n_dropped", runs: LineRuns | None = None) -> DataFrame:
    """``docs``, all columns, without the lines whose key is in ``min_docs`` documents or more;
    ``n_lines`` counts the lines before, ``n_dropped`` those that went. ``runs`` of earlier tables, where given, count too, and take
    in this one's lines."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    path = f"{scratch_dir(spark)}/lines-{uuid.uuid4().hex}"
    keyed = keyed_lines(docs, id_col, text, batches)
    keyed.write.partitionBy("batch").option("compression", "zstd").parquet(path)
    keyed = spark.read.schema(keyed.schema).parquet(path)
    own, runs = runs is None, runs or LineRuns(spark, min_docs)
    for i in range(batches):
        runs.add(keyed.where((F.col("batch") == i) & F.col("first")).select("h1", "h2"))
    frequent = runs.frequent()
    few = frequent.count() <= BROADCAST_KEYS
    if own:
        runs.forget()
    gone = (
        keyed.join(F.broadcast(frequent) if few else frequent, ["h1", "h2"])
        .groupBy(F.col("doc_id").alias("_ld_id"), F.col("d1").alias("_ld_1"), F.col("d2").alias("_ld_2"))
        .agg(F.array_sort(F.collect_set("pos")).alias("_ld_pos"))
    )
    a, b = key128(text)
    rows = docs.withColumns({"_ld_a": a, "_ld_b": b})
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_ld_id")) & (F.col("_ld_a") == F.col("_ld_1")) & (F.col("_ld_b") == F.col("_ld_2"))
    lines = F.split(text, "\n", -1)
    out = rows.join(gone, same, "left").withColumns({"_ld_lines": lines, "_ld_cuts": F.concat(F.array(F.lit(-1)), F.col("_ld_pos"), F.array(F.size(lines)))})

    def between(i: Column) -> Column:
        low, high = F.get("_ld_cuts", i - 1), F.get("_ld_cuts", i)
        return F.slice("_ld_lines", low + 2, high - low - 1)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(1), F.size("_ld_cuts") - 1), between)), "\n")
    out = out.withColumns(
        {
            "_ld_text": F.when(F.col("_ld_pos").isNull(), text).otherwise(kept),
            "_ld_n": F.size("_ld_lines").cast("long"),
            "_ld_gone": F.coalesce(F.size("_ld_pos"), F.lit(0)).cast("long"),
        }
    )
    names = {text_col: "_ld_text", lines_col: "_ld_n", dropped_col: "_ld_gone"}
    columns = [*docs.columns, *[c for c in (lines_col, dropped_col) if c not in docs.columns]]
    return out.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in columns])
