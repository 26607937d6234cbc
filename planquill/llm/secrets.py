"""Secret scans: fixed patterns, and strings that look random under character Markov models.

First-order Markov models over the characters of keys are trained from labelled samples. Random strings are drawn here, a
stated number from each alphabet that keys are written in (``ALPHABETS``), and each alphabet has a model of its own; ordinary
strings are identifiers of the Python language and of its standard modules, written in the usual styles, with
dates, versions and counts, and all words of letters alone in the corpus, whose transitions Spark counts over every document. A run of key characters
is reported as ``random`` where the log-likelihood of the likeliest random model exceeds that of the ordinary one by ``TOTAL`` nats and by a mean
for each transition that is calibrated on samples kept out of the fit: the least that no more than ``FALSE_SHARE`` of the ordinary ones reach.

Models are matrices of transition counts, a fixed few thousand numbers each.

Defined results: null and empty texts have no spans; spans count code points; rows are independent,
so repeated rows and ties are no case; null ids pass through; an empty table gives an empty result, and
models of an empty corpus have the stated samples alone; other columns are ignored.
"""

from __future__ import annotations

import builtins
import importlib
import keyword
import random
import re
import string
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import batched, documents_of

#: The stated base patterns, kind by kind; the value's group and the length it needs. Letters in either case are those of ASCII.
KINDS = ("assign", "access", "hex")
BASE = {
    "assign": (re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # Greedy runs of 24 or more are those runs of any length that are not too short.
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),
}
NAMES = (*KINDS, "random")
CHARACTERS = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-"
SIZE = len(CHARACTERS)
#: Class of each byte, SIZE for what is in no key; other characters become '?' before.
CLASSES = np.full(256, SIZE, dtype=np.int64)
CLASSES[[ord(c) for c in CHARACTERS]] = np.arange(SIZE)
#: Runs shorter than this are too short to tell.
LEAST = 16
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
#: Words that train the ordinary model: letters alone, in lower case after the first.
WORD = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z][a-z]{3,}(?![A-Za-z0-9+/_=-])")

#: Alphabets that keys are written in.
ALPHABETS = {
    "decimal": string.digits,
    "hex": string.digits + "abcdef",
    "base32": string.ascii_uppercase + "234567",
    "base36": string.digits + string.ascii_lowercase,
    "base36_upper": string.digits + string.ascii_uppercase,
    "base62": string.ascii_letters + string.digits,
    "base64": string.ascii_letters + string.digits + "+/",
    "base64url": string.ascii_letters + string.digits + "-_",
}
#: Random strings drawn from each alphabet, and ordinary ones made of identifiers.
RANDOM_SAMPLES = 1_000
ORDINARY_SAMPLES = 8_000
MODULES = ("argparse", "asyncio", "calendar", "collections", "concurrent.futures", "decimal", "email.message", "functools", "http.client", "inspect", "json", "logging", "os", "pathlib", "socket", "sqlite3", "string", "subprocess", "threading", "typing", "urllib.parse", "xml.dom.minidom")
TOTAL = 8.0
FALSE_SHARE = 0.001


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, start of the value), by start and then kind."""
    found = []
    for k, kind in enumerate(KINDS):
        pattern, group, least = BASE[kind]
        if (k == 0 and not ("=" in text or ":" in text)) or (k == 1 and "AKIA" not in text):
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((k, m.start(), m.end(), m.start(group)))
    return sorted(found, key=lambda x: (x[1], x[0]))


def _classes(text: str) -> np.ndarray:
    return CLASSES[np.frombuffer(text.encode("latin-1", "replace"), dtype=np.uint8)]


def _pairs(classes: np.ndarray) -> np.ndarray:
    return classes[:-1] * (SIZE + 1) + classes[1:]


def _transitions(texts: list[str]) -> np.ndarray:
    """Counts of the transitions within strings, by pair of classes."""
    return np.bincount(_pairs(_classes(" ".join(texts))), minlength=(SIZE + 1) ** 2).astype(np.int64) if texts else np.zeros((SIZE + 1) ** 2, dtype=np.int64)


def random_samples(count: int = RANDOM_SAMPLES, seed: int = 17) -> dict[str, list[str]]:
    """Strings labelled random, by alphabet."""
    rng = random.Random(seed)
    return {name: ["".join(rng.choices(letters, k=rng.randint(LEAST, 48))) for _ in range(count)] for name, letters in ALPHABETS.items()}


def ordinary_samples(count: int = ORDINARY_SAMPLES, seed: int = 19) -> list[str]:
    """Strings labelled ordinary: identifiers put together in the usual styles, with dates, versions and counts."""
    names = {n for m in MODULES for n in dir(importlib.import_module(m))} | {*dir(builtins), *keyword.kwlist}
    words = sorted({w.lower() for n in names for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", n) if len(w) > 1})
    rng = random.Random(seed)

    def number() -> str:
        return rng.choice([
            f"{rng.randint(1990, 2035)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}", f"{rng.randint(1990, 2035)}{rng.randint(1, 12):02}{rng.randint(1, 28):02}",
            f"v{rng.randint(0, 12)}", str(rng.randint(0, 99)), f"{rng.randint(1, 999):05}", str(rng.randint(1, 99) * 10 ** rng.randint(1, 6)), f"utf{rng.choice([8, 16, 32])}",
        ])

    def one() -> str:
        parts = [rng.choice(words) for _ in range(rng.randint(2, 5))]
        if rng.random() < 0.3:
            parts.insert(rng.randint(1, len(parts)), number())
        style = rng.randrange(6)
        if style == 0:
            return parts[0] + "".join(p.capitalize() for p in parts[1:])
        if style == 1:
            return "".join(p.capitalize() for p in parts)
        return ("_" if style == 2 else "-" if style == 3 else "/").join(parts) if style < 5 else "_".join(parts).upper()

    return [one() for _ in range(count)]


def word_counts(docs: DataFrame) -> DataFrame:
    """Transition counts (pair, n) of the words of letters alone in every document: labelled ordinary."""

    def run(batches):
        total = np.zeros((SIZE + 1) ** 2, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                total += _transitions([w for text in batch.slice(at, 256).column("text").to_pylist() for w in WORD.findall(text)])
        (some,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["pair", "n"])

    return documents_of(docs).select("text").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _chances(counts: np.ndarray) -> np.ndarray:
    """Transition probabilities among key characters, add-one smoothed."""
    t = counts.reshape(SIZE + 1, SIZE + 1)[:SIZE, :SIZE] + 1.0
    return t / t.sum(axis=1, keepdims=True)


@dataclass
class Model:
    """Log ratios of each random model's transition probabilities to the ordinary one's, and the mean that a run must reach."""

    ratios: np.ndarray
    mean: float = 0.0

    def score(self, run: str) -> float:
        """How much likelier the likeliest random model makes the run, in nats."""
        return float(self.ratios[:, _pairs(_classes(run))].sum(axis=1).max())

    def random(self, run: str) -> bool:
        s = self.score(run)
        return s >= TOTAL and s >= self.mean * (len(run) - 1)


def fit(words: np.ndarray, held_out: int = 4) -> Model:
    """Model of the stated samples and the corpus's word transitions. Every ``held_out``-th sample is kept out of the counts and
    calibrates the mean."""
    drawn, ordinary = random_samples(), ordinary_samples()
    kept = [s for i, s in enumerate(ordinary) if i % held_out]
    common = _chances(_transitions(kept))
    if words.sum():
        # Words are written in capitals too. Words and identifiers weigh the same, however large the corpus is.
        words = words.reshape(SIZE + 1, SIZE + 1).copy()
        lower, upper = slice(0, 26), slice(26, 52)
        words[upper, upper] += words[lower, lower]
        common = (common + _chances(words)) / 2
    ratios = []
    for samples in drawn.values():
        table = np.zeros((SIZE + 1, SIZE + 1))
        table[:SIZE, :SIZE] = np.log(_chances(_transitions([s for i, s in enumerate(samples) if i % held_out])) / common)
        ratios.append(table.ravel())
    model = Model(np.array(ratios))
    means = [model.score(s) / (len(s) - 1) for s in ordinary[::held_out] if len(s) >= LEAST]
    model.mean = max(float(np.quantile(means, 1 - FALSE_SHARE, method="higher")), 1e-6) + 1e-9
    return model


def train(docs: DataFrame) -> Model:
    """``fit`` with the words of all ``docs``; collects at most (SIZE + 1) ** 2 numbers."""
    words = np.zeros((SIZE + 1) ** 2, dtype=np.int64)
    for pair, n in word_counts(docs).collect():
        words[pair] = n
    return fit(words)


FOUND = "doc_id long, spans array<struct<kind:string,start:int,end:int>>, base_only array<struct<kind:string,start:int,end:int>>"


def _struct(kind: int, start: int, end: int) -> dict:
    return {"kind": NAMES[kind], "start": start, "end": end}


def random_spans(text: str, base: list[tuple[int, int, int, int]], model: Model) -> list[tuple[int, int, int]]:
    """Runs that look random and touch no base span. Base spans are put together first, so that each run looks at one of them."""
    starts: list[int] = []
    ends: list[int] = []
    for _, s, e, _ in base:
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    out = []
    for m in RUN.finditer(text):
        s, e = m.span()
        last = bisect_left(starts, e) - 1
        if (last < 0 or ends[last] <= s) and model.random(m[0]):
            out.append((len(KINDS), s, e))
    return out


def find_secrets(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of every document: the base patterns', and as kind ``random`` the runs of ``LEAST`` or more
    key characters apart from those that the model takes for random."""

    def work(columns: dict) -> Iterator[tuple]:
        for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
            base = base_spans(text)
            every = sorted([b[:3] for b in base] + (random_spans(text, base, model) if model else []), key=lambda x: (x[1], x[0]))
            yield doc_id, [_struct(*x) for x in every], [_struct(*b[:3]) for b in base]

    return documents_of(docs, id_col, text_col).mapInArrow(batched(FOUND, work, ["doc_id", "text"]), FOUND)
