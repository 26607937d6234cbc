"""Document fingerprints by Order MinHash.

A text's k-mers of code points (with k - 1 leading blanks, so that a text has as many k-mers as code
points) are numbered by occurrence. For each of ``SKETCHES`` hash functions the ``TUPLE`` smallest
numbered k-mers are put back into text order and hashed as a tuple. Equal sketches need
shared k-mers in the same order, which makes them sensitive to edit distance where MinHash is not.
The likeness of two fingerprints is the share of equal sketches, taken to the power 1 / TUPLE: near the
share of numbered k-mers that the texts have in common.

Defined results: null and empty texts have the fingerprint of no k-mers, equal to each other's (likeness
1) and to no other's (0); texts of any length are taken whole and every id of the long type is one; rows with the same id stand
in order of a hash of their text; rows without an id come last in descending order; a single document is its own next; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import documents_of, shuffle_partitions, stored

K = 8
TUPLE = 2
SKETCHES = 40
BLANK = 0x110000
MIX = np.uint64(0x9E3779B97F4A7C15)
SEEDS = (np.random.default_rng(11).integers(0, 1 << 63, SKETCHES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
#: Powers of the base of the rolling hash, by the width of what is joined.
BASES = {w: np.uint64(pow(0x100000001B3, w, 1 << 64)) for w in (1, 2, 4)}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def numbered_kmers(codes: np.ndarray) -> np.ndarray:
    """A hash of (k-mer, occurrence number) at each position."""
    h = np.concatenate([np.full(K - 1, BLANK, dtype=np.uint64), codes.astype(np.uint64)])
    span = 1
    while span < K:
        h = h[:-span] * BASES[span] + h[span:]
        span *= 2
    h = _mixed(h)
    # Only k-mers that occur again need a number.
    ordered = np.sort(h)
    repeated = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(repeated):
        at = np.flatnonzero(repeated[np.minimum(np.searchsorted(repeated, h), len(repeated) - 1)] == h)
        at = at[np.argsort(h[at], kind="stable")]
        groups = h[at]
        first = np.zeros(len(at), dtype=np.int64)
        first[1:] = np.where(groups[1:] != groups[:-1], np.arange(1, len(at)), 0)
        again = np.arange(len(at)) - np.maximum.accumulate(first)
        h[at] = np.where(again > 0, _mixed(groups + again.astype(np.uint64) * MIX), groups)
    return h


def fingerprint(codes: np.ndarray) -> np.ndarray:
    """The sketches of a text given by its code points."""
    if not len(codes):
        return np.zeros(SKETCHES, dtype=np.uint32)
    h = numbered_kmers(codes)
    picked = np.empty((SKETCHES, min(TUPLE, len(h))), dtype=np.int64)
    largest = np.uint64(0xFFFFFFFFFFFFFFFF)
    for s, seed in enumerate(SEEDS):
        g = h * seed
        for t in range(picked.shape[1]):
            picked[s, t] = i = g.argmin()
            g[i] = largest
    picked.sort(axis=1)
    out = np.arange(1, SKETCHES + 1, dtype=np.uint64)
    for t in range(picked.shape[1]):
        out = out * MIX + h[picked[:, t]]
    return ((_mixed(out) >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean() ** (1 / TUPLE))


def as_text(sketches: np.ndarray) -> str:
    return sketches.astype(">u4").tobytes().hex()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (sketches of eight hexadecimal digits) of every document."""
    from ._common import batched

    schema = "doc_id long, fingerprint string"

    def work(columns: dict) -> Iterator[tuple]:
        for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
            yield doc_id, as_text(fingerprint(code_points(text)))

    return documents_of(docs, id_col, text_col).mapInArrow(batched(schema, work, ["doc_id", "text"]), schema)


def in_order_with_next(docs: DataFrame) -> DataFrame:
    """Documents cut into ranges of their order; each range (``_range``) ends with a copy of the
    first document of the range after it (``_copy``), the last range with the very first document.

    The order is descending id, then hash of the text, then text. Ids are cut at approximate quantiles, one number a range; rows
    without an id, and those of an id that fills a range or more alone, are cut evenly by the hash. What is copied is one document a range.
    """
    spark = docs.sparkSession
    d = documents_of(docs).withColumn("_hash", F.xxhash64("text"))
    parts = max(2, shuffle_partitions(spark))
    found = d.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 8 * parts).alias("cuts")).first()["cuts"] or []
    cuts = sorted(set(found), reverse=True)
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    heavy = [c for c in cuts if found.count(c) > 1]
    crowded = F.col("doc_id").isNull() | (F.col("doc_id").isin(heavy) if heavy else F.lit(False))
    # Twice as many places as ranges: an odd place is a crowded id's own.
    place = F.when(F.col("doc_id").isNull(), F.lit(2 * parts)).otherwise(2 * F.size(F.filter(bounds, lambda b: b > F.col("doc_id"))) + crowded.cast("int"))
    share = F.floor((F.col("_hash") / float(1 << 64) + 0.5) * parts).cast("int")
    d = d.withColumn("_place", place * (parts + 1) + F.when(crowded, share).otherwise(F.lit(0)))
    order = F.struct(F.bitwise_not("doc_id").alias("o"), "_hash", "text")
    heads = stored(d.groupBy("_place").agg(F.min(order).alias("m")).select("_place", F.col("m.text").alias("text")), "heads")
    places = sorted(r["_place"] for r in heads.select("_place").collect())
    numbers = spark.createDataFrame([(p, i, (i - 1) % len(places)) for i, p in enumerate(places)], "_place int, _range int, _to int")
    copies = heads.join(F.broadcast(numbers), "_place").select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("_hash"), F.col("_to").alias("_range"), F.lit(True).alias("_copy"))
    own = d.join(F.broadcast(numbers), "_place").select("doc_id", "text", "_hash", "_range", F.lit(False).alias("_copy"))
    return own.unionByName(copies).repartitionById(max(1, len(places)), "_range").sortWithinPartitions("_range", "_copy", F.col("doc_id").desc_nulls_last(), "_hash", "text")


def with_edited(docs: DataFrame, edit: Callable[[str, str], str], row: Callable[..., tuple], schema: str) -> DataFrame:
    """For each document ``row(doc_id, text, edited, prints)``, where ``edited`` is ``edit(text, next
    text)`` and ``prints`` the fingerprints of the text, of the edited and of the next text. A range is streamed: two
    documents are held at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, 128):
                    part = batch.slice(at, 128)
                    yield from zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "_copy")), strict=True)

        out, last = [], None
        for doc_id, text, copy in rows():
            own = fingerprint(code_points(text))
            if last is not None:
                before_id, before, prints = last
                edited = edit(before, text)
                changed = prints if edited == before else fingerprint(code_points(edited))
                out.append(row(before_id, before, edited, (prints, changed, own)))
                if len(out) >= 1024:
                    yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*out), arrow, strict=True)], schema=arrow)
                    out = []
            last = None if copy else (doc_id, text, own)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*out), arrow, strict=True)], schema=arrow)

    return in_order_with_next(docs).mapInArrow(run, schema)
