"""Token counts that survive edits: a segment tree of pre-token sums for each document, kept between batches of edits.

The leaves of a document's tree are runs of whole pre-tokens of about ``LEAF_CHARS`` code points; a pre-token longer than that (a text
without spaces, say) is cut between its tokens. Inner nodes hold the sums of code points and tokens below them. An
edit (position, code points deleted, text inserted) descends by code-point sums to the leaves it
touches; these are joined, edited and encoded again, and only the sums on their paths change. A border between what was
encoded again and the leaf beside it holds if the token before and the token after encode to themselves when put together
(an encoding by merges is right if every two neighbours in it are), and if no pre-token's choice can reach across it: no white space and no apostrophe
stands right before it. Where a border does not hold, that leaf is boundary context: it is taken in and the region is encoded once more.

``build`` makes the trees of documents; ``TreeStore`` keeps them in a folder: the first build, then a small table of changed trees for each batch of
edits, compacted when there are ``FANOUT`` of those. A batch reads the trees of the documents that it edits and encodes what it touches.

Defined results: null and empty text count 0 tokens; a null list of edits leaves the document as it
is; positions and deletions beyond the text are clamped to it, null fields count as 0 or ''; edits apply
in list order to the text that the ones before left; rows are independent, so repeated rows and ties
are no case for ``count_with_edits``, while a store goes by id: it takes one document an id, refuses others, and has no null ids; edits of unknown ids do
nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import batched, delete, documents_of
from .pretokens import WordIds, word_ids

#: Code points in a leaf, about, when a tree is built.
LEAF_CHARS = 96
#: Tables of changed trees that are compacted into one.
FANOUT = 4


class CountTree:
    """Segment tree over leaves of text; ``tokens`` is the count of the whole."""

    def __init__(self, words: WordIds, text: str | None = None, kept: tuple[list[str], list[int], list[int]] | None = None):
        """Of a text, or of the leaves and sums that ``kept`` holds, where nothing is encoded."""
        self.words, self.encoded = words, 0
        if kept is None:
            self.plant(*self.cut(text or ""))
        else:
            self.texts, self.char_sums, self.token_sums = kept
            self.size = len(self.texts)

    def plant(self, texts: list[str], counts: list[int]) -> None:
        """The tree over these leaves."""
        self.size = 1
        while self.size < len(texts):
            self.size *= 2
        pad = [0] * (self.size - len(texts))
        self.texts = texts + [""] * len(pad)
        chars, tokens = [0] * self.size + [len(t) for t in self.texts], [0] * self.size + counts + pad
        for i in range(self.size - 1, 0, -1):
            chars[i], tokens[i] = chars[2 * i] + chars[2 * i + 1], tokens[2 * i] + tokens[2 * i + 1]
        self.char_sums, self.token_sums = chars, tokens

    def cut(self, text: str) -> tuple[list[str], list[int]]:
        """Leaves of a text that opens a pre-token, and their numbers of tokens."""
        first, rest = self.words.cut(text)
        ids = self.words.words(rest)
        parts = [(first, len(self.words.encode([first])[0]) // 4), *[(" " + w, len(ids[w]) // 4) for w in rest]]
        texts, counts, held, tokens = [], [], "", 0
        for part, n in parts:
            for t, k in self.finer(part) if len(part) > LEAF_CHARS else ((part, n),):
                if len(held) + len(t) > LEAF_CHARS and holds_alone(held):
                    texts.append(held)
                    counts.append(tokens)
                    held, tokens = "", 0
                held += t
                tokens += k
        return [*texts, held], [*counts, tokens]

    def finer(self, part: str) -> list[tuple[str, int]]:
        """A long part cut between tokens where a border holds."""
        out, start, first = [], 0, 0
        spans = self.words.spans(part)
        for i in range(1, len(spans)):
            at = spans[i][0]
            if at - start >= LEAF_CHARS and spans[i - 1][1] == at and holds_alone(part[max(start, at - 2) : at]):
                out.append((part[start:at], i - first))
                start, first = at, i
        return [*out, (part[start:], len(spans) - first)]

    @property
    def tokens(self) -> int:
        return self.token_sums[1]

    @property
    def length(self) -> int:
        return self.char_sums[1]

    def text(self) -> str:
        return "".join(self.texts)

    def leaf(self, at: int) -> tuple[int, int]:
        """The leaf with code point ``at`` and the code points before that leaf."""
        i, before = 1, 0
        while i < self.size:
            i *= 2
            if at - before >= self.char_sums[i] and self.char_sums[i + 1]:
                before += self.char_sums[i]
                i += 1
        return i - self.size, before

    def put(self, k: int, text: str, tokens: int) -> None:
        self.texts[k] = text
        i = k + self.size
        chars, sums = self.char_sums, self.token_sums
        chars[i], sums[i] = len(text), tokens
        while i > 1:
            i //= 2
            chars[i], sums[i] = chars[2 * i] + chars[2 * i + 1], sums[2 * i] + sums[2 * i + 1]

    def near(self, k: int, step: int) -> int:
        """The next leaf that holds text, in one direction; -1 if there is none. Subtrees without text are stepped over."""
        i = k + self.size
        while i > 1:
            if i % 2 == (step < 0) and self.char_sums[i ^ 1]:
                i ^= 1
                while i < self.size:
                    i = 2 * i + (step < 0)
                    if not self.char_sums[i]:
                        i ^= 1
                return i - self.size
            i //= 2
        return -1

    def edit(self, at: int, delete: int, insert: str) -> None:
        at = min(max(at, 0), self.length)
        delete = min(max(delete, 0), self.length - at)
        if not delete and not insert:
            return
        low, before = self.leaf(max(at - 1, 0))
        high, _ = self.leaf(min(at + delete, max(self.length - 1, 0)))
        high = max(low, high)
        old = "".join(self.texts[low : high + 1])
        new = old[: at - before] + insert + old[at - before + delete :]
        while True:
            # The region stands between the leaves left and right; both are kept only where their borders hold.
            left, right = self.near(low, -1), self.near(high, 1)
            if new:
                spans = self.words.spans(new)
                self.encoded += len(new)
                if left >= 0 and not self.border(self.texts[left], new, None, spans):
                    low, new = left, self.texts[left] + new
                elif right >= 0 and not self.border(new, self.texts[right], spans, None):
                    high, new = right, new + self.texts[right]
                else:
                    break
            elif left >= 0:
                low, new = left, self.texts[left]
            elif right >= 0:
                high, new = right, self.texts[right]
            else:
                spans = []
                break
        for k in range(low + 1, high + 1):
            if self.texts[k]:
                self.put(k, "", 0)
        if len(new) <= 8 * LEAF_CHARS:
            self.put(low, new, len(spans))
        else:
            # A large region becomes leaves of its own and the sums above are made anew; nothing else is encoded.
            texts, counts = self.cut(new)
            whole = [(t, self.token_sums[self.size + i]) for i, t in enumerate(self.texts)]
            whole[low : high + 1] = list(zip(texts, counts, strict=True))
            self.plant(*map(list, zip(*[(t, n) for t, n in whole if t], strict=True)))

    def border(self, before: str, after: str, before_spans: list | None, after_spans: list | None) -> bool:
        """Whether the tokens of both sides stay as they are side by side."""
        if not holds_alone(before):
            return False
        if after[0].isspace():
            return True  # white space after none always opens a pre-token
        a = before_spans if before_spans is not None else self.words.spans(before)
        b = after_spans if after_spans is not None else self.words.spans(after)
        self.encoded += (len(before) if before_spans is None else 0) + (len(after) if after_spans is None else 0)
        # The tokens of the character on either side: one token, or several that share it.
        i, j = len(a) - 1, 0
        while i > 0 and a[i - 1][1] > a[i][0]:
            i -= 1
        while j + 1 < len(b) and b[j + 1][0] < b[j][1]:
            j += 1
        start = a[i][0]
        beside = len(before) - start
        want = [(s - start, e - start, n) for s, e, n in a[i:]] + [(s + beside, e + beside, n) for s, e, n in b[: j + 1]]
        return self.words.spans(before[start:] + after[: b[j][1]]) == want


def holds_alone(before: str) -> bool:
    """Whether no pre-token's choice can reach across the end of ``before``: white space joins what follows, and an
    apostrophe with up to two letters is a pre-token."""
    return bool(before) and not before[-1].isspace() and "'" not in before[-2:]


EDITED = "doc_id long, n_tokens long, n_tokens_edited long, n_chars_edited long, n_chars_encoded long, edited_text string"
EDITS = "array<struct<pos:int,n_del:int,ins:string>>"
TREE = "doc_id long, texts array<string>, char_sums array<int>, token_sums array<int>"


def _apply(tree: CountTree, edits: list | None) -> None:
    for e in edits or []:
        if e is not None:
            tree.edit(e["pos"] or 0, e["n_del"] or 0, e["ins"] or "")


def build(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The tree of every document: its leaves, and the sums of code points and tokens of its nodes from the root."""

    def work(columns: dict) -> Iterator[tuple]:
        words = word_ids(tokenizer_path)
        for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
            tree = CountTree(words, text)
            yield doc_id, tree.texts, tree.char_sums, tree.token_sums

    return documents_of(docs, id_col, text_col).mapInArrow(batched(TREE, work, ["doc_id", "text"]), TREE)


def edited(trees: DataFrame, tokenizer_path: str, keep: bool = True) -> DataFrame:
    """Trees with a column ``edits`` after these edits (without ``keep``, their counts alone), with the tokens before, the tokens and code points after, and
    the code points encoded for the edits."""
    counts = "n_tokens_before long, n_tokens long, n_chars long, n_chars_encoded long"
    schema = f"{TREE}, {counts}" if keep else f"doc_id long, {counts}"

    def work(columns: dict) -> Iterator[tuple]:
        words = word_ids(tokenizer_path)
        for doc_id, texts, chars, tokens, edits in zip(*(columns[c] for c in ("doc_id", "texts", "char_sums", "token_sums", "edits")), strict=True):
            tree = CountTree(words, kept=(texts, chars, tokens))
            before = tree.tokens
            _apply(tree, edits)
            after = before, tree.tokens, tree.length, tree.encoded
            yield (doc_id, tree.texts, tree.char_sums, tree.token_sums, *after) if keep else (doc_id, *after)

    rows = trees.select("doc_id", "texts", "char_sums", "token_sums", F.col("edits").cast(EDITS).alias("edits"))
    return rows.mapInArrow(batched(schema, work, ["doc_id", "texts", "char_sums", "token_sums", "edits"]), schema)


class TreeStore:
    """Trees in a folder: those first built and, newest last, tables of the trees that batches changed. Opening a folder finds what earlier
    sessions wrote there; each table is whole before its name is, so a batch that fails leaves the trees as they were. One
    session writes at a time."""

    def __init__(self, spark: SparkSession, folder: str, tokenizer_path: str):
        self.spark, self.folder, self.tokenizer_path = spark, folder.rstrip("/"), tokenizer_path

    def _fs(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _tables(self) -> list[str]:
        fs, path = self._fs()
        names = sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []
        return [f"{self.folder}/{n}" for n in names if n.startswith("trees-")]

    def _write(self, df: DataFrame) -> str:
        fs, _ = self._fs()
        Path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        last = self._tables()
        number = int(last[-1].rsplit("-", 1)[1]) + 1 if last else 0
        unfinished, name = f"{self.folder}/unfinished-{uuid.uuid4().hex}", f"{self.folder}/trees-{number:08}"
        df.write.option("compression", "zstd").parquet(unfinished)
        if not fs.rename(Path(unfinished), Path(name)):
            raise OSError(f"{name} could not be named")
        return name

    def build(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """The trees of ``docs``, in an empty folder."""
        if self._tables():
            raise ValueError(f"{self.folder} holds trees already")
        ids = docs.select(F.col(id_col).alias("id")).groupBy("id").count()
        if ids.where("count > 1 OR id IS NULL").limit(1).count():
            raise ValueError("a store takes one document an id, and no null ids")
        self._write(build(docs, self.tokenizer_path, id_col, text_col))

    def trees(self) -> DataFrame:
        """Every document's tree as it stands: of several, the newest."""
        return self._newest(self._tables())

    def _newest(self, names: list[str]) -> DataFrame:
        out = self.spark.createDataFrame([], TREE)
        for name in names:
            one = self.spark.read.schema(TREE).parquet(name)
            out = one if name == names[0] else out.join(one.select("doc_id"), "doc_id", "left_anti").unionByName(one)
        return out

    def edit(self, edits: DataFrame) -> DataFrame:
        """Apply a batch, (doc_id, edits) with a row an id at most. Returns (doc_id, n_tokens_before, n_tokens, n_chars, n_chars_encoded) of
        the documents that it names, to be read before the next batch."""
        batch = edits.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("edits").cast(EDITS).alias("edits"))
        if batch.groupBy("doc_id").count().where("count > 1").limit(1).count():
            raise ValueError("a batch has one list of edits an id")
        changed = self._tables()[1:]
        if len(changed) >= FANOUT:
            # What batches changed becomes one table, newer than all; the first trees are not rewritten.
            self._write(self._newest(changed))
            for name in changed:
                delete(self.spark, name)
        name = self._write(edited(self.trees().join(batch, "doc_id"), self.tokenizer_path))
        return self.spark.read.parquet(name).select("doc_id", "n_tokens_before", "n_tokens", "n_chars", "n_chars_encoded")

    def counts(self) -> DataFrame:
        """(doc_id, n_tokens, n_chars) of every document, from the roots of the trees."""
        return self.trees().select("doc_id", *sums())


def sums() -> list[Column]:
    """Tokens and code points of a tree, from its root."""
    return [F.get(c, F.lit(1)).cast("long").alias(n) for c, n in (("token_sums", "n_tokens"), ("char_sums", "n_chars"))]


def count_with_edits(docs: DataFrame, edits: Column, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Token counts before and after ``edits``, an array of structs (pos int, n_del int, ins string)
    for each row, of trees that are not kept. ``n_chars_encoded`` is the code points encoded again because of them."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        edits.cast(EDITS).alias("edits"),
    )

    def work(columns: dict) -> Iterator[tuple]:
        words = word_ids(tokenizer_path)
        for doc_id, text, changes in zip(columns["doc_id"], columns["text"], columns["edits"], strict=True):
            tree = CountTree(words, text)
            n = tree.tokens
            _apply(tree, changes)
            yield doc_id, n, tree.tokens, tree.length, tree.encoded, tree.text() if keep_text else None

    return rows.mapInArrow(batched(EDITED, work, ["doc_id", "text", "edits"]), EDITED)
