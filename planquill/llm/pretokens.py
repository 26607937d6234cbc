"""Ids of whole texts under a byte-level BPE file, by memo of space-separated words.

In these vocabularies' pre-tokenizer a space followed by a non-space always opens a pre-token and
merges stay inside pre-tokens; so the words of a text, each with the space before it, are encoded
alone. Words met before come from a bounded memo, the others go to the tokenizers library together.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache
from itertools import chain

#: Words in each of two generations; the older one is dropped when the newer is full.
MEMO = 400_000
MEMO_CHARS = 48
#: Where a text may be cut: before a space that a non-space follows.
CUT = re.compile(r" (?=\S)")
#: A space that no word follows at once.
ODD = re.compile(r" (?:\s|\Z)")


class WordIds:
    """Little-endian 32-bit ids of words and texts, as bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.processors import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.post_processor = ByteLevel(trim_offsets=False)  # spans of tokens keep the space that opens them
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def cut(self, text: str) -> tuple[str, list[str]]:
        """The text up to its first cut, and then the words without the space before each."""
        if not ODD.search(text):
            first, *rest = text.split(" ")
            if first:
                return first, rest
        out, start = [], 0
        for m in CUT.finditer(text):
            out.append(text[start : m.start()])
            start = m.start() + 1
        out.append(text[start:])
        return out[0], out[1:]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as they stand."""
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, id) of the tokens of a text as it stands, in code points; tokens that share a character overlap."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        return [(s, t, i) for (s, t), i in zip(e.offsets, e.ids, strict=True)]

    def words(self, words) -> dict[str, bytes]:
        """Ids of words with a space before each; at least those asked for."""
        if len(self.memo) > MEMO:
            self.memo, self.older = {}, self.memo
        memo, older, new = self.memo, self.older, []
        for w in set(words).difference(memo):
            if w in older:
                memo[w] = older[w]
            else:
                new.append(w)
        fresh = dict(zip(new, self.encode([" " + w for w in new]), strict=True))
        long = {w: ids for w, ids in fresh.items() if len(w) > MEMO_CHARS}
        memo.update((w, ids) for w, ids in fresh.items() if len(w) <= MEMO_CHARS)
        return _Both(memo, long) if long else memo

    def texts(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut(t) for t in texts]
        look = self.words(chain.from_iterable(rest for _, rest in cut)).__getitem__
        return [b"".join([first, *map(look, rest)]) for first, (_, rest) in zip(self.encode([f for f, _ in cut]), cut, strict=True)]


class _Both(dict):
    """A small dictionary in front of a large one."""

    def __init__(self, large: dict, small: dict):
        super().__init__(small)
        self.large = large

    def __missing__(self, key):
        return self.large[key]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
