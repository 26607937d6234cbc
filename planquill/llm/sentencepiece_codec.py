"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding runs the score-ordered agenda: adjacent symbol pairs that form a piece wait in a heap by
(score, position); the best pair is merged, its neighbours enter the agenda, stale entries are
skipped. Two characters that stand side by side in no piece can never end in one symbol, so a text
is cut there first and every segment is encoded alone; a bounded memo keeps segments that were
already encoded. Whatever is new in an Arrow batch is also encoded by the sentencepiece library,
whose answer is kept and counted in ``n_corrected`` where the two differ. Decoding maps ids to
pieces and bytes and is compared with the library's decode for every text.

Defined results: null and empty text give the end id alone and decode to the empty string; texts of
any length are taken whole; repeated rows and null ids pass through; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

from pyspark.sql import DataFrame

from ._common import batched, documents_of

SPACE = "▁"
#: Words whose ids, as bytes, a worker remembers in each of two generations; the older one is dropped when the newer is
#: full, which costs time and no result.
MEMO = 600_000
#: Longer words are not remembered.
MEMO_CHARS = 48


class PieceCodec:
    """Encoder and decoder of one model file with an identity normaliser."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.trainer_spec.model_type != pb.TrainerSpec.BPE:
            raise ValueError("only merge-type vocabularies are encoded here")
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only the identity normaliser is supported")
        kind = pb.ModelProto.SentencePiece
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.order = {p.piece: -p.score for p in model.pieces if p.type == kind.NORMAL}
        self.end = next(i for i, p in enumerate(model.pieces) if p.piece == model.trainer_spec.eos_piece)
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN)
        self.byte_ids = [0] * 256
        self.surface: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == kind.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.surface.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == kind.NORMAL:
                self.surface.append(p.piece.replace(SPACE, " ").encode())
            else:
                self.surface.append(model.trainer_spec.unk_surface.encode() if p.type == kind.UNKNOWN else b"")
        self.fallback = model.trainer_spec.byte_fallback
        #: Characters that are neighbours within some piece: only these can ever be merged.
        self.joined = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        self.words = not any(a != SPACE and b == SPACE for a, b in self.joined)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def agenda(self, text: str) -> list[int]:
        """Ids of one segment. An entry is score, position and piece; it is stale when what now stands
        there is another piece."""
        order, symbols, n = self.order, list(text), len(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(order[p], i, p) for i in range(n - 1) if (p := text[i : i + 2]) in order]
        heapify(heap)
        while heap:
            _, i, piece = heappop(heap)
            j = after[i]
            if j >= n or symbols[i] is None or symbols[i] + symbols[j] != piece:
                continue
            symbols[i], symbols[j] = piece, None
            after[i] = right = after[j]
            if right < n:
                before[right] = i
                if (p := piece + symbols[right]) in order:
                    heappush(heap, (order[p], i, p))
            left = before[i]
            if left >= 0 and (p := symbols[left] + piece) in order:
                heappush(heap, (order[p], left, p))
        out: list[int] = []
        for s in symbols:
            if s is not None:
                if (i := self.ids.get(s)) is not None:
                    out.append(i)
                elif self.fallback:
                    out.extend(self.byte_ids[b] for b in s.encode())
                else:
                    out.append(self.unknown)
        return out

    def segment(self, word: str) -> bytes:
        """Ids of a word, cut where no piece can reach across. What stands before the first cut is a
        word that the memo may know already."""
        joined = self.joined
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in joined]
        if not cuts:
            return array("i", self.agenda(word)).tobytes()
        out, start, opening = [], 0, len(self.prefix)
        for i in [*cuts, len(word)]:
            part = word[start:i]
            memo, key = (self.memo, part[opening:]) if start == 0 and i > opening else (self.parts, part)
            ids = memo.get(key)
            if ids is None:
                ids = array("i", self.agenda(part)).tobytes()
                if len(part) <= MEMO_CHARS:
                    if memo is self.parts and len(memo) >= MEMO:
                        memo.clear()
                    memo[key] = ids
            out.append(ids)
            start = i
        return b"".join(out)

    def split(self, text: str) -> list[str]:
        """Words without the space mark that precedes each; with it, they are the escaped text."""
        if not text:
            return []
        if not self.words or not self.prefix:
            return [text.replace(" ", SPACE)]
        if SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            out, marks = [], 0
            for part in text.replace(" ", SPACE).split(SPACE):
                marks += 1
                if part:
                    out.append(SPACE * (marks - 1) + part)
                    marks = 0
            return out + [SPACE * (marks - 1)] * bool(marks)
        return text.split(" ")

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[int]]:
        """Ids of each text with the end id, and how many words of each needed the library's answer."""
        split = [self.split(t) for t in texts]
        if len(self.memo) > MEMO:
            self.memo, self.older = {}, self.memo
            self.parts.clear()
        memo, older = self.memo, self.older
        kept: dict[str, bytes] = {}
        wrong: set[str] = set()
        new = []
        for w in set(chain.from_iterable(split)).difference(memo):
            if w in older:
                memo[w] = older[w]
            else:
                new.append(w)
        if new:
            plain = [w.replace(SPACE, " ") for w in new]
            for word, text, theirs in zip(new, plain, self.library.encode(plain, num_threads=1), strict=True):
                ids = self.segment(self.prefix + word)
                if text and ids != array("i", theirs).tobytes():
                    wrong.add(word)
                    ids = array("i", theirs).tobytes()
                (memo if len(word) <= MEMO_CHARS else kept)[word] = ids
        look = (lambda w: kept[w] if w in kept else memo[w]) if kept else memo.__getitem__
        ids = []
        for words in split:
            one = array("i", b"".join(map(look, words))).tolist()
            one.append(self.end)
            ids.append(one)
        return ids, [sum(w in wrong for w in words) if wrong else 0 for words in split]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


@lru_cache(maxsize=1)
def _decimals() -> list[str]:
    return [str(i) for i in range(1 << 18)]


def full_row(doc_id, ids: list[int], decoded: str, corrected: int) -> tuple:
    return doc_id, ids, decoded, corrected


def digest_row(doc_id, ids: list[int], decoded: str, corrected: int) -> tuple:
    text = " ".join(map(_decimals().__getitem__, ids))
    return doc_id, len(ids), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), corrected


FULL = "doc_id long, ids array<int>, decoded string, n_corrected int"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_corrected int"


def encode_decode(docs: DataFrame, model_path: str, row: Callable[..., tuple] = full_row, schema: str = FULL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids (with the end id) and decoded text of every document. ``row`` shapes the output row of
    (doc_id, ids, decoded, n_corrected) inside the worker, so that digests need not carry the ids."""

    def work(columns: dict) -> Iterator[tuple]:
        c = codec(model_path)
        ids, corrected = c.encode(columns["text"])
        for doc_id, own, theirs, wrong in zip(columns["doc_id"], ids, c.library.decode(ids), corrected, strict=True):
            text = c.decode(own)
            yield row(doc_id, own, text if text == theirs else theirs, wrong + (text != theirs))

    return documents_of(docs, id_col, text_col).mapInArrow(batched(schema, work, ["doc_id", "text"]), schema)
