"""N-gram Jaccard self-join by MinHash banding, verified on full n-gram sets.

A document's set is its word 5-grams (words are what ASCII white space separates; a shorter text is one
n-gram). Equal sets are one class with a weight, so exact copies are never paired. Signatures are
cut into bands; band and row counts are chosen as the widest bands whose recall at the threshold
reaches the target. Band hashes are shuffled alone; sets that share one are linked to the
smallest of their (salted) bucket, and the components of these links are the groups in which pairs are verified.
A group is dealt into blocks and each pair of blocks is one task: sets meet there by intersection counts, so no
pair is a row; a task gives each set its number of links and an edge to the smallest set of
its part of the spanning forest, whose components are the classes. A group of g sets costs g * ceil(g / BLOCK_SETS) set rows and up to g * g / 2
comparisons in its tasks, be it one of true near copies or a chain of false candidates; no task meets more than two blocks.

Defined results: a null or wordless text has no n-grams, no links, and is its own class; equal texts are
linked; a row's class id is the smallest doc_id in the class (null only if all are); repeated rows are documents of their own, linked as copies; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import batched, documents_of, dropped, stored
from .components import connected

N = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
MAX_HASHES = 128
#: Sets and n-grams that a block holds on average.
BLOCK_SETS = 256
BLOCK_GRAMS = 400_000
#: Rows of (id, key) that are broadcast at most, 16 bytes each; more are joined by shuffle.
BROADCAST_ROWS = 500_000

STEP = np.uint64(0x9E3779B97F4A7C15)


def bands_for(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band, hence fewest false candidates, that reach the target
    recall for a pair at the threshold with ``hashes`` at most; then the fewest bands that do."""
    for rows in range(hashes, 0, -1):
        for bands in range(1, hashes // rows + 1):
            if 1 - (1 - threshold**rows) ** bands >= recall:
                return bands, rows
    return hashes, 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def grams(text: str, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams."""
    from xxhash import xxh3_64_intdigest

    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < n:
        return np.array([xxh3_64_intdigest(b" ".join(words))], dtype=np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    h = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for k in range(n):
        h = _mixed((h + w[k : len(words) - n + 1 + k]) * STEP)
    return np.unique(h)


def signer(bands: int, rows: int):
    """A function from a set to its band hashes; a band's hash tells its place too."""
    seeds = (np.random.default_rng(5).integers(0, 1 << 63, bands * rows, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
    places = np.arange(1, bands + 1, dtype=np.uint64) * STEP

    def sign(h: np.ndarray) -> np.ndarray:
        low = np.full(bands * rows, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
        for at in range(0, len(h), 512):
            low = np.minimum(low, (h[at : at + 512, None] * seeds).min(axis=0))
        out = places.copy()
        for column in low.reshape(bands, rows).T:
            out = _mixed(out + column)
        return out.view(np.int64)

    return sign


def signatures(docs: DataFrame, bands: int, rows: int, n: int = N) -> DataFrame:
    """doc_id, k (key of the text), sid (128-bit key of the set, null without one), its size, band hashes."""
    schema = "doc_id long, k long, sid binary, size int, bands array<long>"
    d = documents_of(docs).withColumn("k", F.xxhash64("text"))

    def work(columns: dict) -> Iterator[tuple]:
        from xxhash import xxh3_128_digest

        sign = signer(bands, rows)
        for doc_id, text, k in zip(columns["doc_id"], columns["text"], columns["k"], strict=True):
            h = grams(text, n)
            yield (doc_id, k, xxh3_128_digest(h.tobytes()), len(h), sign(h)) if len(h) else (doc_id, k, None, 0, None)

    return d.mapInArrow(batched(schema, work, ["doc_id", "text", "k"]), schema)


def _candidate_groups(sets: DataFrame) -> DataFrame:
    """(n, group) of the sets, by number, that share a band hash with another."""
    bucket = sets.select("n", F.explode("bands").alias("h"))
    shared = stored(bucket.groupBy("h").agg(F.count("*").alias("held")).where("held > 1").select("h"), "buckets")
    members = stored(bucket.join(shared, "h"), "members")
    # Salted, so that a bucket of very many sets is met by no task whole: sets link to the smallest of
    # their share, shares to the smallest of all.
    salted = members.withColumn("salt", F.pmod(F.xxhash64("n"), F.lit(64)))
    share = stored(salted.groupBy("h", "salt").agg(F.min("n").alias("m")), "shares")
    whole = share.groupBy("h").agg(F.min("m").alias("top"))
    edges = salted.join(share, ["h", "salt"]).select(F.col("n").alias("a"), F.col("m").alias("b"))
    edges = edges.unionByName(share.join(whole, "h").select(F.col("m").alias("a"), F.col("top").alias("b")))
    groups = connected(edges).select(F.col("node").alias("n"), F.col("label").alias("group"))
    dropped(shared, members, share)
    return groups


def _links(threshold: float):
    """Verify the pairs of a task: sets of one block among each other, or of two blocks across."""
    schema = pa.schema([("n", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        p, q = (int(k.as_py()) for k in key[1:])
        seen: dict[int, int] = {}
        number, block, weight = (table.column(c).to_pylist() for c in ("n", "block", "weight"))
        keep = [i for i, s in enumerate(number) if seen.setdefault(s, i) == i]
        column = table.column("grams").combine_chunks()
        flat, offsets = np.frombuffer(column.values.buffers()[1], dtype=np.int64)[column.values.offset :][: len(column.values)].view(np.uint64), column.offsets.to_numpy()
        keep.sort(key=lambda i: (offsets[i + 1] - offsets[i], number[i]))
        rows = [flat[offsets[i] : offsets[i + 1]] for i in keep]
        sizes = np.array([len(r) for r in rows])
        block, weight = np.array([block[i] for i in keep]), np.array([weight[i] for i in keep], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        distinct, ids = np.unique(np.concatenate(rows), return_inverse=True)
        links, parent, mark = np.zeros(len(keep), dtype=np.int64), list(range(len(keep))), np.zeros(len(distinct), dtype=bool)

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i in range(len(keep) - 1):
            # Sets are in order of size: beyond size / threshold no set can be near enough.
            end = int(np.searchsorted(sizes, sizes[i] / threshold + 1e-9, side="right"))
            if end <= i + 1:
                continue
            own = ids[starts[i] : starts[i + 1]]
            mark[own] = True
            common = np.add.reduceat(mark[ids[starts[i + 1] : starts[end]]], starts[i + 1 : end] - starts[i + 1], dtype=np.int64)
            mark[own] = False
            near = common >= threshold * (sizes[i] + sizes[i + 1 : end] - common) - 1e-9
            if p != q:
                near &= block[i + 1 : end] != block[i]
            for j in np.flatnonzero(near) + i + 1:
                links[i] += weight[j]
                links[j] += weight[i]
                a, b = root(i), root(int(j))
                if a != b:
                    parent[max(a, b)] = min(a, b)
        some = np.flatnonzero(links)
        names = [number[i] for i in keep]
        return pa.table({"n": [names[i] for i in some], "root": [names[root(int(i))] for i in some], "links": links[some]}, schema=schema)

    return run


def classes(docs: DataFrame, threshold: float = THRESHOLD, n: int = N, recall: float = TARGET_RECALL, hashes: int = MAX_HASHES) -> DataFrame:
    """doc_id, k (key of the text), class_id, n_links (documents at the threshold or nearer) and class_key of every row. Classes
    have different keys even where ids repeat; a text without n-grams has none."""
    bands, rows = bands_for(threshold, recall, hashes)
    every = stored(signatures(docs, bands, rows, n), "signatures")
    last = F.lit(2**63 - 1)
    sets = every.where(F.col("sid").isNotNull()).groupBy("sid").agg(
        F.count("*").alias("weight"), F.min(F.struct(F.coalesce("doc_id", last).alias("o"), "doc_id", "k")).alias("at"), F.first("bands").alias("bands"), F.first("size").alias("size")
    )
    # Sets are numbered once and for all as they are written; numbers are half as wide as keys.
    sets = stored(sets.select(F.monotonically_increasing_id().alias("n"), "sid", "weight", F.col("at.doc_id").alias("doc_id"), F.col("at.k").alias("k"), "bands", "size"), "sets")
    members = _candidate_groups(sets.select("n", "bands")).join(sets.drop("bands"), "n")
    candidates = members = stored(members, "candidates")
    groups = members.groupBy("group").agg(F.count("*").alias("g"), F.sum("size").alias("grams"))
    blocks = groups.select("group", F.ceil(F.greatest(F.col("g") / BLOCK_SETS, F.col("grams") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    members = stored(members.join(blocks, "group").withColumn("block", F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int")), "blocks")
    spark = docs.sparkSession
    dropped(candidates)
    spark.sparkContext._jvm.System.gc()  # lets Spark drop the shuffle files of joins that are over

    wanted = members.select(F.col("doc_id").alias("w_id"), F.col("k").alias("w_k"))
    same = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("k") == F.col("w_k"))
    texts = documents_of(docs).withColumn("k", F.xxhash64("text"))
    few = members.count() <= BROADCAST_ROWS
    texts = texts.join(F.broadcast(wanted) if few else wanted, same, "left_semi").select("text")
    schema = "sid binary, grams array<long>"

    def work(columns: dict) -> Iterator[tuple]:
        from xxhash import xxh3_128_digest

        for text in columns["text"]:
            h = grams(text, n)
            yield xxh3_128_digest(h.tobytes()), h.view(np.int64)

    full = texts.mapInArrow(batched(schema, work, ["text"]), schema)
    met = (
        full.join(members.select("n", "sid", "group", "weight", "blocks", "block"), "sid")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("group", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "n", "block", "weight", "grams")
    )
    verified = stored(met.groupBy("group", "p", "q").applyInArrow(_links(threshold), "n long, root long, links long"), "links")
    linked = verified.groupBy("n").agg(F.sum("links").alias("links"))
    labels = connected(verified.select(F.col("n").alias("a"), F.col("root").alias("b")))
    parts = sets.select("n", "sid", "weight", "doc_id").join(linked, "n", "left").where((F.col("weight") > 1) | F.col("links").isNotNull())
    parts = stored(parts.join(labels.withColumnRenamed("node", "n"), "n", "left").withColumn("label", F.coalesce("label", "n")), "parts")
    dropped(verified)
    least = parts.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    known = stored(parts.join(least, "label").select("sid", "label", "class_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "classes")
    out = every.select("doc_id", "k", "sid").join(known, "sid", "left")
    return out.select("doc_id", "k", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce(F.hex("label"), F.hex("sid")).alias("class_key"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs``, all columns: of each class one row stays, that with the smallest id (null ids last; of ids that repeat, the smallest
    key of its text; of rows alike in id and text, one). Texts without n-grams all stay but for rows alike."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    of = classes(plain, **settings)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k")).alias("m")
    keep = of.where(F.col("class_key").isNotNull()).groupBy("class_key").agg(first).select(F.col("m.doc_id").alias("_jj_id"), F.col("m.k").alias("_jj_1"))
    keep = keep.unionByName(of.where(F.col("class_key").isNull()).select(F.col("doc_id").alias("_jj_id"), F.col("k").alias("_jj_1")))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumn("_jj_k", F.xxhash64(text)).withColumn("_jj_own", F.col(id_col).cast("long"))
    same = F.col("_jj_own").eqNullSafe(F.col("_jj_id")) & (F.col("_jj_k") == F.col("_jj_1"))
    out = rows.join(keep, same, "left_semi").dropDuplicates(["_jj_own", "_jj_k"])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
