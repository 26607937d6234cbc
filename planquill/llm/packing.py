"""Packing token pieces into sequences of one length by minimum bin slack.

Documents are cut into whole sequences and one remainder each. Only the histogram of remainder
lengths (at most ``window`` - 1 numbers, whatever the corpus) reaches the driver. There a window is
filled by subset-sum over the multiset of remaining lengths, kept as bits of one integer: the
reachable total closest to capacity is taken, counts are backtracked, and the pattern found is used
as often as the remaining counts allow; so patterns number at most about two a length. Spark then numbers the
remainders of each length (salted, so that no length meets in one task) and looks up the sequence
and offset of each number.

Defined results: null and empty texts have the end id alone; ids are cut nowhere but at whole
sequences; repeated rows are documents of their own; null ids pass through; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import batched, documents_of, stored
from .pretokens import word_ids

#: A text without any of this has the same ids in either library: no class of the pre-tokenizer's
#: pattern is in doubt for its characters, and it holds no special token.
DOUBTFUL = re.compile(r"[^\t\n\r\x20-~¡-¬®-ſ‘-”]|<\|")
#: Remainders that one task numbers together, on average.
GROUP_ROWS = 20_000

PIECES = "doc_id long, text_key long, start long, length long, ids_crc32 long, doc_tokens long"


class TokenBytes:
    """Ids of a text with the end id, as little-endian 32-bit bytes."""

    def __init__(self, path: str, ranks_path: str | None, end: int):
        self.slow = word_ids(path)
        self.end = np.array([end], dtype="<u4").tobytes()
        self.fast = None
        if ranks_path:
            import base64

            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.fast and not DOUBTFUL.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes() + self.end
        return self.slow.texts([text])[0] + self.end


@lru_cache(maxsize=2)
def token_bytes(path: str, ranks_path: str | None, end: int) -> TokenBytes:
    return TokenBytes(path, ranks_path, end)


def pieces(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, window: int = 2048, end: int = 1) -> DataFrame:
    """Every document's tokens cut at whole windows: a row per piece."""

    def work(columns: dict) -> Iterator[tuple]:
        encode = token_bytes(tokenizer_path, ranks_path, end)
        for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
            ids = encode(text)
            key, n = zlib.crc32(ids), len(ids) // 4
            for start in range(0, n, window):
                part = ids[4 * start : 4 * (start + window)]
                yield doc_id, key, start, len(part) // 4, zlib.crc32(part), n

    return documents_of(docs).mapInArrow(batched(PIECES, work, ["doc_id", "text"]), PIECES)


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of ``counts`` with the largest total up to ``capacity``. Longer lengths come
    first, and of equal totals the one that uses later (shorter) lengths least is backtracked."""
    mask, lengths = (1 << capacity + 1) - 1, sorted(counts, reverse=True)
    reach = [1]
    for length in lengths:
        bits, left, step = reach[-1], min(counts[length], capacity // length), 1
        while left > 0:
            use = min(step, left)
            bits |= bits << use * length & mask
            left, step = left - use, 2 * step
        reach.append(bits)
        if bits >> capacity & 1:
            break
    total, chosen = reach[-1].bit_length() - 1, {}
    for k in range(len(reach) - 1, 0, -1):
        while total and not reach[k - 1] >> total & 1:
            length = lengths[k - 1]
            chosen[length] = chosen.get(length, 0) + 1
            total -= length
    return chosen


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first number, repeats, first sequence, offset): the remainders of a length
    numbered ``first .. first + repeats - 1`` go to consecutive sequences at that offset. Each
    window must hold a longest remaining length, as in minimum-bin-slack packing."""
    left, used, rows, sequence = dict(histogram), dict.fromkeys(histogram, 0), [], 0
    while left:
        longest = max(left)
        rest = {n: c - (n == longest) for n, c in left.items() if n <= capacity - longest and c > (n == longest)}
        chosen = fill(rest, capacity - longest) if rest else {}
        chosen[longest] = chosen.get(longest, 0) + 1
        repeats, offset = min(left[n] // c for n, c in chosen.items()), 0
        for n, c in sorted(chosen.items(), reverse=True):
            for _ in range(c):
                rows.append((n, used[n], repeats, sequence, offset))
                used[n] += repeats
                offset += n
            left[n] -= c * repeats
            if not left[n]:
                del left[n]
        sequence += repeats
    return rows


def numbered(df: DataFrame, counts: DataFrame, order: list, name: str) -> DataFrame:
    """Number rows from 0 within each length, of which ``counts`` (length, count) tells the rows. Each length is dealt into as many
    groups of about GROUP_ROWS rows as it needs; rows of a group are numbered together and groups are shifted by what precedes them."""
    groups = counts.select("length", F.ceil(F.col("count") / GROUP_ROWS).cast("long").alias("_groups"))
    salted = df.join(F.broadcast(groups), "length").withColumn("_salt", F.pmod(F.xxhash64(*order), F.col("_groups"))).drop("_groups")
    keys = ["length", "_salt"]
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = salted.groupBy(*keys).count().select(*keys, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    within = salted.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return within.join(shift, keys).withColumn(name, F.col("_rank") - 1 + F.col("_shift")).drop("_salt", "_rank", "_shift")


def pack(pieces_df: DataFrame, window: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of ``length`` up to ``window``. Whole pieces fill
    a sequence each; they are numbered after those of the remainders."""
    spark = pieces_df.sparkSession
    # A row's number, written with it, tells rows apart that are alike in all else.
    kept = stored(pieces_df.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in kept.groupBy("length").count().collect()}
    lengths = spark.createDataFrame(list(counts.items()), "length long, count long")
    counts.pop(window, None)
    rows = plan(counts, window)
    sequences = max((s + r for _, _, r, s, _ in rows), default=0)
    order = ["doc_id", "start", "ids_crc32", "text_key", "_row"]
    slots = spark.createDataFrame(rows, "slot_length long, first long, repeats long, first_sequence long, offset long")
    short = numbered(kept.where(F.col("length") < window), lengths, order, "_number")
    # Slots are a row for each place of each pattern: at most window lengths by some places, so they are broadcast.
    at = (F.col("length") == F.col("slot_length")) & (F.col("_slot") == F.col("first"))
    starts = spark.createDataFrame([(n, sorted(f for m, f, *_ in rows if m == n)) for n in counts], "slot_n long, starts array<long>")
    placed = (
        short.join(F.broadcast(starts), F.col("length") == F.col("slot_n"))
        .withColumn("_slot", F.aggregate("starts", F.lit(0).cast("long"), lambda a, s: F.when(s <= F.col("_number"), F.greatest(a, s)).otherwise(a)))
        .join(F.broadcast(slots), at)
        .withColumn("sequence_id", F.col("first_sequence") + F.col("_number") - F.col("first"))
    )
    full = numbered(kept.where(F.col("length") == window), lengths, order, "_number")
    full = full.withColumn("sequence_id", F.col("_number") + sequences).withColumn("offset", F.lit(0).cast("long"))
    columns = [*pieces_df.columns, "sequence_id", "offset"]
    return placed.select(*columns).unionByName(full.select(*columns))
