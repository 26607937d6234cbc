"""Each operator against brute force over texts of every kind."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from planquill.llm import edit_counts, fingerprints, jaccard_join, line_dedup, neighbours, packing, pii, pretokens, quality, queries, secrets, sentencepiece_codec
from tests.conftest import rows_of

from .conftest import documents, nasty_rows

MODEL, BPE, RANKS = queries.PIECE_MODEL, queries.BYTE_BPE, queries.BYTE_RANKS


def plain(rows):
    return [(d, t or "") for d, t in rows]


def tables(tmp_path, **frames):
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


# 1 -------------------------------------------------------------------------------------------------


def test_sentencepiece_equals_library(spark, nasty, tmp_path):
    rows, docs = nasty
    got = queries.op1_sentencepiece(spark, tables(tmp_path, documents=docs)).collect()
    lib = sentencepiece_codec.codec(MODEL).library
    want = Counter()
    for d, t in plain(rows):
        ids = lib.encode(t, add_eos=True)
        want[(d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest(), 0)] += 1
    assert Counter(map(tuple, got)) == want


def test_sentencepiece_random_texts_and_round_trip():
    c, rng = sentencepiece_codec.codec(MODEL), random.Random(3)
    texts = ["".join(rng.choice("ab ▁.\n\tçé1☃😀<>s/日") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    ids, corrected = c.encode(texts)
    assert ids == c.library.encode(texts, add_eos=True) and not any(corrected)
    assert [c.decode(i) for i in ids] == c.library.decode(ids)


def test_sentencepiece_full_rows_and_empty(spark, nasty, nothing):
    rows, docs = nasty
    out = sentencepiece_codec.encode_decode(docs, MODEL).collect()
    assert Counter(r["decoded"] for r in out) == Counter(t for _, t in plain(rows) if "▁" not in t) + Counter(t.replace("▁", " ") for _, t in plain(rows) if "▁" in t)
    assert sentencepiece_codec.encode_decode(nothing, MODEL).count() == 0


# 2 -------------------------------------------------------------------------------------------------


def brute_fingerprint(text: str) -> np.ndarray:
    """k-mers numbered by a dictionary, minima by sorting."""
    if not text:
        return np.zeros(fingerprints.SKETCHES, dtype=np.uint32)
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    h = fingerprints.numbered_kmers(codes).tolist()
    out = []
    for s, seed in enumerate(fingerprints.SEEDS.tolist(), 1):
        at = sorted(sorted(range(len(h)), key=lambda i: (h[i] * seed) % 2**64)[: fingerprints.TUPLE])
        v = s
        for i in at:
            v = (v * int(fingerprints.MIX) + h[i]) % 2**64
        out.append(v)
    return ((fingerprints._mixed(np.array(out, dtype=np.uint64)) >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)


def text_hash(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def test_fingerprints_of_extreme_and_crowded_ids(spark):
    """Ids at both ends of the long type, very many rows without an id, and one id on very many rows."""
    rows = [(-(2**63), "first of all"), (2**63 - 1, "last of all"), (2**63 - 2, "near the end"), (0, "zero")]
    rows += [(None, f"no id {i}") for i in range(300)] + [(77, f"same id {i}") for i in range(300)] + [(5, "five"), (78, "six")]
    df = documents(spark, rows)
    out = fingerprints.with_edited(df, queries._third_replaced, lambda d, t, e, p: (d, t, e), "doc_id long, a string, e string").collect()
    order = sorted((d is None, -(d or 0), text_hash(t), t) for d, t in rows)
    want = Counter((None if gone else -d, t, queries._third_replaced(t, order[(j + 1) % len(order)][3])) for j, (gone, d, _, t) in enumerate(order))
    assert Counter(map(tuple, out)) == want
    sizes = Counter(r["_range"] for r in fingerprints.in_order_with_next(df).collect())
    assert max(sizes.values()) < 150


def test_kmers_of_long_texts_are_numbered_alike():
    """No way of its own beyond any length: a long text's k-mers are those of its parts, numbered on."""
    rng = np.random.default_rng(3)
    part = rng.integers(97, 123, 1 << 20).astype(np.uint32)
    whole = np.concatenate([part] * 5)
    h = fingerprints.numbered_kmers(whole)
    assert (h[: len(part)] == fingerprints.numbered_kmers(part)).all()
    assert len(np.unique(h)) == len(whole)


def test_kmers_are_numbered_by_occurrence():
    for text in ("abcdefgh" * 3, "aaaa aaaa aaaa aaaa", "x" * 50, "no repeats: qwertyuiop"):
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        padded = [None] * (fingerprints.K - 1) + list(text)
        seen, names = Counter(), []
        for i in range(len(text)):
            k = tuple(padded[i : i + fingerprints.K])
            names.append((k, seen[k]))
            seen[k] += 1
        h = fingerprints.numbered_kmers(codes)
        assert len(set(h.tolist())) == len(set(names)) == len(text)
    a, b = (fingerprints.numbered_kmers(np.frombuffer(t.encode("utf-32-le"), dtype="<u4")) for t in ("one prefix repeated one prefix", "one prefix repeated one pre then else"))
    assert (a[:24] == b[:24]).all()


def test_fingerprints_against_brute_force(spark, nasty, tmp_path):
    rows, docs = nasty
    got = queries.op2_order_minhash(spark, tables(tmp_path, documents=docs)).collect()
    texts = plain(rows)
    order = sorted((d is None, -(d or 0), text_hash(t), t, i) for i, (d, t) in enumerate(texts))
    want = []
    for j, (*_, t, i) in enumerate(order):
        following = order[(j + 1) % len(order)][3]
        n = len(t) // 3
        edited = t[: len(t) - n] + following[:n]
        prints = [brute_fingerprint(x) for x in (t, edited, following)]
        d = texts[i][0]
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), *map(fingerprints.as_text, prints[:2]), fingerprints.likeness(prints[0], prints[1]), fingerprints.likeness(prints[0], prints[2])))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3], r[6])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    equal = {d: r for d, r in ((r["doc_id"], r["fingerprint"]) for r in got)}
    assert equal[7] == equal[8] != equal[9]


def test_fingerprints_feel_order():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    text = " ".join(words)
    edited = " ".join(words[:200] + [w[::-1] for w in words[200:]])
    moved = " ".join(words[150:] + words[:150])
    f = lambda t: fingerprints.fingerprint(fingerprints.code_points(t))
    assert fingerprints.likeness(f(text), f(text)) == 1
    assert 0.2 < fingerprints.likeness(f(text), f(edited)) < 0.9
    assert fingerprints.likeness(f(text), f(moved)) < 1
    assert fingerprints.likeness(f(text), f(" ".join(w[::-1] for w in words))) == 0


def test_fingerprints_one_and_no_document(spark, nothing):
    schema = "doc_id long, a string, e string"
    one = fingerprints.with_edited(documents(spark, [(4, "abcdef")]), queries._third_replaced, lambda d, t, e, p: (d, t, e), schema)
    assert [tuple(r) for r in one.collect()] == [(4, "abcdef", "abcdab")]
    assert fingerprints.with_edited(nothing, queries._third_replaced, lambda d, t, e, p: (d, t, e), schema).count() == 0
    assert fingerprints.fingerprints(nothing).count() == 0


# 3 -------------------------------------------------------------------------------------------------

PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(s))) % 10 == 0


def pii_ok(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in v.split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def brute_pii(t):
    return [(k, m.start(), m.end()) for k, p in PII.items() for m in re.finditer(p, t) if pii_ok(k, m[0])]


def test_pii_base_spans(spark):
    rng = random.Random(3)
    texts = [
        "a@b.c_d@e.f", "x" * 20000, "1" * 20000, "a@" + "b." * 6000 + "c", "1.2.3.4.5.6.7.8 001.0255.3.4 256.1.1.1", "+1 " * 2000, "4111 1111 1111 1111 " * 20, "4111-1111-1111-1111",
        "+1 (234) 555-6789 10+49 30 123456-", "é☃😀 bob@x.yz 😀 +1234567890", "", "😀" * 10 + "10.0.0.1", "a.b@c@d.e@f.g", "1 " * 9000, "a%b+c@-.-", " +" * 50 + "12345678 9",
    ]
    texts += ["".join(rng.choice("ab@.1 2+-()3_é4") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in df.select("doc_id", pii.base_spans(F.col("text")).alias("b")).collect():
        assert [(pii.KINDS[s.kind], s.start, s.end) for s in r.b] == brute_pii(texts[r.doc_id])


def test_pii_query_and_masking(spark, nasty, nothing, tmp_path):
    rows, docs = nasty
    got = queries.op3_pii(spark, tables(tmp_path, documents=docs)).collect()
    want = Counter()
    for d, t in plain(rows):
        base = brute_pii(t)
        want[(d, *[sum(k == b[0] for b in base) for k in pii.KINDS], hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:6] for r in got) == want
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns
    out = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert out[15] == "mail [EMAIL] or [PHONE] now" and out[7] == rows[7][1] and out[0] == ""
    assert pii.sanitise(nothing).count() == 0 and pii.find(nothing).count() == 0


def brute_terms(rows, share=pii.SHARE, most=pii.GENERALISE, remove=pii.REMOVE):
    """(start, end, action, term) of each text by counting every pair of entity and word by document."""
    docs = []
    for _, t in rows:
        base = brute_pii(t)
        entities = {(k, re.sub("[^0-9]", "", t[s:e]) if k in ("card", "phone") else t[s:e].lower()) for k, s, e in base}
        words = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\W_]+", t)]
        docs.append((t, entities, [w for w in words if not any(w[0] < e and s < w[1] for _, s, e in base)], {w[2].lower() for w in words if base} or {w[2].lower() for w in words}))
    n, n_e, n_t, both = len(docs), Counter(), Counter(), Counter()
    for _, entities, visible, every in docs:
        n_e.update(entities)
        n_t.update(every)
        both.update((e, w) for e in entities for w in {w[2].lower() for w in visible})
    left = {}
    for (e, w), k in both.items():
        p = n_e[e] / n
        near = (k + p) / (n_t[w] + 1)
        if p < 1 and -np.log2(near) <= most and np.log2(near / p) / -np.log2(p) >= share:
            left[w] = min(left.get(w, 9), -np.log2(near))
    return [(t, [(s, e, "remove" if left[w.lower()] <= remove else "generalise", w) for s, e, w in visible if entities and w.lower() in left]) for t, entities, visible, _ in docs]


def with_people(seed=9, n=400):
    """Texts of common words, some with one of a few addresses and a rare name or number that goes with it."""
    rng = random.Random(seed)
    common = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    people = [("ada@x.org", "Zanzibarian 4711"), ("10.1.2.3", "kraken x9y"), ("+44 20 7946 0958", "Ömer"), ("4111 1111 1111 1111", "quux")]
    rows = []
    for i in range(n):
        words = [rng.choice(common) for _ in range(40)]
        if i % 13 == 0:
            for who, tells in rng.sample(people, rng.randint(1, 2)):
                words[rng.randrange(5)] = who + ","
                words[rng.randrange(30, 40)] = tells if rng.random() < 0.8 else "nothing"
        rows.append((i, " ".join(words) + (f" only{i}" if i % 7 == 0 else "")))
    return rows + [(n, rows[0][1]), (n + 1, "Zanzibarian stands alone"), (n + 2, "")]


def test_pii_terms_against_brute_force(spark):
    rows = with_people()
    got = {r.doc_id: [tuple(x) for x in r.added] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {d: spans for (d, _), (_, spans) in zip(rows, brute_terms(rows), strict=True)}
    assert got == want
    assert {w for spans in want.values() for *_, w in spans} >= {"Zanzibarian", "4711", "kraken", "x9y", "Ömer", "quux"} and not want[len(rows) - 2]


def test_pii_terms_are_removed_or_generalised_everywhere(spark):
    """Words of any length and numbers, however far from the entity, at every place of documents with personal data."""
    far = "common words " * 30
    rows = [(i, f"Kim 4711 {far} ada@x.org, {far} kim.") for i in range(4)]
    rows += [(4, f"Zoe, {far} bob@x.org {far} z9, 77, yes. bo@x.org"), (5, f"kim alone {far} eve@x.org")]
    rows += [(10 + i, f"{far} without any address, yes" if not i else f"{far} without any address") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).where("doc_id < 11").collect()}
    assert clean[0] == f"[] [] {far} [EMAIL], {far} []." and clean[10] == rows[6][1]
    assert clean[4] == f"[NAME], {far} [EMAIL] {far} [CODE], [NUMBER], yes. [EMAIL]"
    assert clean[5] == f"[] [WORD] {far} [EMAIL]"
    scan, added = pii.search(docs)
    assert "ada@" not in str(scan.where("size(entities) > 0").collect()) and added.count() == 3


def test_pii_terms_go_in_documents_without_personal_data(spark, tmp_path):
    far = "common words " * 5
    rows = [(i, f"Kim 4711 {far} ada@x.org {far}{i}") for i in range(8)] + [(20, f"ask kim, {far} or KIM"), (21, f"ask kim, {far} or KIM"), (22, f"nobody {far}"), (23, None)]
    rows += [(100 + i, far + str(i)) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = queries.op3_pii(spark, tables(tmp_path, documents=docs)).collect()
    got = {r.doc_id: r.other_spans for r in out}
    assert all(not r.spans and not r.n_spans for r in out if r.doc_id >= 20) and all(not r.other_spans and "term:0:3" in r.spans for r in out if r.doc_id < 20)
    at = rows[8][1].index("KIM")
    assert got[20] == got[21] == f"term:4:7,term:{at}:{at + 3}" and got[22] == got[23] == got[105] == ""
    clean = {r.doc_id: r.text for r in pii.sanitise(docs, everywhere=True).collect()}
    assert clean[20] == clean[21] == f"ask [], {far} or []" and clean[22] == rows[10][1] and clean[23] == "" and len(clean) == len(rows)
    assert clean[0] == f"[] [] {far} [EMAIL] {far}0"


def test_pii_entities_of_the_same_texts_are_one_class(spark):
    rows = [(i, " ".join(f"u{j}@x.org" for j in range(50)) + f" word{i}") for i in range(3)] + [(9, "u1@x.org z@x.org")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = pii.entity_classes(pii.held_texts(docs, pii._scan(docs))).collect()
    assert len(classes) == 51 and len({r["class"] for r in classes}) == 3 and sorted({r.n_entity for r in classes}) == [1, 3, 4]


def test_pii_finds_terms_in_the_given_tables(spark):
    got = queries.op3_pii(spark, "/root/testdata/sf0.01").collect()
    assert sum("term:" in r.spans for r in got) >= 20 and all("term:" not in r.spans or r.n_email + r.n_ip + r.n_card + r.n_phone for r in got)
    assert all(r.n_spans == (r.spans.count(",") + 1 if r.spans else 0) for r in got)


def test_pii_words_hide_base_spans(spark):
    for text in ("Kim 4711 ada@x.org, kim.", "x a@b.c_d 4111 1111 1111 1111 +1 (234) 555-6789Kim é☃😀 bob@x.yz 10.0.0.1 end", "1.2.3.4@x.org 10.0.0.1 4111 1111 1111 1111", "", "none"):
        one = spark.createDataFrame([(1, text)], "doc_id long, text string")
        got = one.select(pii._words(F.col("text"), pii.base_spans(F.col("text"))).alias("w")).first().w
        base = brute_pii(text)
        assert [tuple(w) for w in got] == [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\W_]+", text) if not any(m.start() < e and s < m.end() for _, s, e in base)]


def test_pii_long_texts(spark):
    """Many spans in one text: time near its length, places exact."""
    n = 30_000
    text = " ".join(f"é{i} user{i}@mail.example.com" for i in range(n))
    docs = spark.createDataFrame([(1, text), (2, "10.0.0.1 " * n)], "doc_id long, text string")
    got = {r.doc_id: r.base for r in pii.find(docs).collect()}
    assert [(s.start, s.end) for s in got[1]] == [m.span() for m in re.finditer(r"user[0-9]+@mail.example.com", text)] and len(got[2]) == n
    assert {r.doc_id: r.text for r in pii.sanitise(docs).collect()}[2] == "[IP] " * n


# 4 -------------------------------------------------------------------------------------------------


def test_quality_dual_descent_meets_the_optimum():
    """At the optimum each row's dual variable and margin satisfy the conditions of Karush, Kuhn and Tucker."""
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 40, 12)) + (20 if i % 2 else 0) for i in range(60)]
    y = np.where(np.arange(60) % 2, 1.0, -1.0)
    ratio = quality.log_count_ratio(rows, y)
    w, b = quality.dual_descent(rows, y, ratio, cost=1.0, epochs=2000, tolerance=1e-6)
    scale = [np.sqrt((ratio[x] ** 2).sum() + 1) for x in rows]
    margins = np.array([yi * (w[x].sum() + b) / s for x, yi, s in zip(rows, y, scale, strict=True)])
    hinge = np.maximum(0, 1 - margins).sum()
    v = np.divide(w, ratio, out=np.zeros_like(w), where=ratio != 0)
    primal = 0.5 * ((v**2).sum() + b**2) + hinge
    for _ in range(200):
        shift = rng.normal(size=v.shape) * 1e-2
        moved = [yi * ((v + shift)[x] @ ratio[x] + b) / s for x, yi, s in zip(rows, y, scale, strict=True)]
        assert 0.5 * (((v + shift) ** 2).sum() + b**2) + np.maximum(0, 1 - np.array(moved)).sum() >= primal - 1e-3


def test_quality_held_out_accuracy(spark, tmp_path):
    folder = "/root/testdata/sf0.01"
    got = queries.op4_quality(spark, folder).toPandas()
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall())
    assert len(got) == 1000 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in zip(got.doc_id, got.held_out, strict=True))
    right = [(p == labels[d]) for d, p, h in zip(got.doc_id, got.predicted, got.held_out, strict=True) if h and d in labels]
    assert np.mean(right) >= 0.9


def test_quality_edges(spark, nasty, nothing, tmp_path):
    rows, docs = nasty
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 0), (11, 1, 0), (12, 0, 0), (13, 1, 0), (None, 1, 0), (14, None, 0), (100, 1, 0), (101, 0, 1), (102, 1, 0)], "doc_id long, quality int, toxic int")
    got = queries.op4_quality(spark, tables(tmp_path, documents=docs, labels=labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    model = quality.train(nothing, labels)
    assert quality.score(docs, model).where("score != 0.5").count() == 0
    assert quality.score(nothing, model).count() == 0 and quality.accepted(docs, model, 0.4).columns == docs.columns
    assert quality.train(docs, labels.where("quality = 1")).score("any text") > 0.9


# 5 -------------------------------------------------------------------------------------------------


def test_packing_places_every_id_once(spark, nasty, tmp_path):
    rows, docs = nasty
    got = queries.op5_packing(spark, tables(tmp_path, documents=docs)).toPandas()
    tokenizer = pretokens.word_ids(BPE).tokenizer
    want = Counter()
    for d, t in plain(rows):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], dtype="<u4")
        for s in range(0, len(ids), 2048):
            want[(d if d is not None else -1, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes()), len(ids))] += 1
    got = got.assign(doc_id=got.doc_id.fillna(-1).astype(int))
    assert Counter(map(tuple, got[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].itertuples(index=False))) == want
    for _, g in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 2048
    total = got.length.sum()
    assert got.sequence_id.nunique() <= -(-total // 2048) + 1


def test_packing_fill_is_optimal_and_plan_complete():
    rng = random.Random(5)
    for _ in range(200):
        counts, capacity = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(1, 6))}, rng.randint(1, 60)
        chosen = packing.fill(counts, capacity)
        assert all(chosen[n] <= counts[n] for n in chosen)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= capacity}
        assert sum(n * c for n, c in chosen.items()) == max(sums)
    for size in (0, 1, 700):
        histogram = Counter(rng.randint(1, 255) for _ in range(size))
        seen, bins = Counter(), defaultdict(int)
        for n, first, repeats, sequence, _ in packing.plan(dict(histogram), 256):
            assert first == seen[n]
            seen[n] += repeats
            for i in range(repeats):
                bins[sequence + i] += n
        assert seen == histogram and all(b <= 256 for b in bins.values())


def test_packing_fast_ids_equal_the_library(spark, nothing):
    fast, slow = packing.token_bytes(BPE, RANKS, 1), packing.token_bytes(BPE, None, 1)
    rng = random.Random(2)
    texts = [t for _, t in plain(nasty_rows())] + ["".join(rng.choice("ab1 .'\n\té<|>stre —") for _ in range(rng.randint(0, 80))) for _ in range(2000)]
    assert [fast(t) for t in texts] == [slow(t) for t in texts]
    assert packing.pack(packing.pieces(nothing, BPE)).count() == 0


# 6 -------------------------------------------------------------------------------------------------

SECRETS = {"assign": (r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), "access": (r"AKIA[A-Z0-9]+", 0, 20), "hex": (r"[0-9a-f]+", 0, 24)}


def brute_secrets(t):
    found = [(m.start(), i, k, m.end()) for i, (k, (p, g, least)) in enumerate(SECRETS.items()) for m in re.finditer(p, t) if len(m[g]) >= least]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def test_secrets_against_brute_force(spark, nasty, nothing, tmp_path):
    rows, docs = nasty
    got = queries.op6_secrets(spark, tables(tmp_path, documents=docs)).collect()
    want = Counter()
    for d, t in plain(rows):
        base = brute_secrets(t)
        want[(d, *[sum(k == b[0] for b in base) for k in SECRETS], hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    assert secrets.find_secrets(nothing, secrets.train(nothing)).count() == 0


def test_secrets_random_texts():
    rng = random.Random(8)
    bits = ["token", "API_KEY", "secret", "=", ":", " ", '"', "'", "abc123", "AKIA", "ABCDEFGHIJKLMNOP1234", "deadbeef" * 3, "0f", "é", "\n", "Token: tok: x=yyyyyyy", "pa\u017f\u017fword=abcdefgh", "to\u212aen=abcdefgh"]
    for _ in range(4000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        assert [(secrets.KINDS[k], s, e) for k, s, e, _ in secrets.base_spans(t)] == brute_secrets(t)


def test_secrets_models_tell_held_out_strings(spark):
    """Random strings and identifiers that no fit saw, by rates."""
    model = secrets.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    drawn = secrets.random_samples(300, seed=101)
    for name, strings in drawn.items():
        long = [x for x in strings if len(x) >= 20]
        assert np.mean([model.random(x) for x in long]) >= 0.95, name
    ordinary = [x for x in secrets.ordinary_samples(4000, seed=103) if len(x) >= secrets.LEAST]
    assert np.mean([model.random(x) for x in ordinary]) <= 0.005


def test_secrets_scan_finds_random_strings_in_text(spark):
    rng = random.Random(4)
    planted = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    words = "the connection_manager handles configuration_settings for internationalization and authenticationProviderFactory requests of 2024-05-17/backup".split()
    docs = spark.createDataFrame([(1, f"see é {planted} here"), (2, " ".join(words) + " configuration_settings_internationalization")], "doc_id long, text string")
    out = {r.doc_id: r.spans for r in secrets.find_secrets(docs, secrets.train(docs)).collect()}
    assert [(s.kind, s.start, s.end) for s in out[1]] == [("random", 6, 46)] and not out[2]


def test_secrets_random_spans_in_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r.spans for r in queries.op6_secrets(spark, folder).collect()}
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall())
    found = {texts[d][int(s):int(e)] for d, spans in got.items() for k, s, e in (x.split(":") for x in spans.split(",") if x) if k == "random"}
    words = {m[0] for t in texts.values() for m in secrets.RUN.finditer(t) if m[0].isalpha()}
    assert found and len(found & words) <= 0.01 * len(words)


def test_secrets_many_spans_in_one_text():
    text = "token=abcdef1 " * 20_000 + "deadbeef" * 5 + " 8f3Kq0Zb7LxW2nRt5YvC" * 5000
    base = secrets.base_spans(text)
    assert len(secrets.random_spans(text, base, secrets.fit(np.zeros((secrets.SIZE + 1) ** 2)))) == 5000


# 7 -------------------------------------------------------------------------------------------------


def brute_neighbours(vectors, k=10):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], dtype=np.float64)
    out = {}
    for i, v in zip(ids, x, strict=True):
        if i % 100 == 0:
            d = np.sqrt(((x - v) ** 2).sum(axis=1))
            out[int(i)] = [(int(ids[j]), float(d[j])) for j in np.lexsort((ids, d)) if ids[j] != i][:k]
    return out


def test_neighbours_recall_and_scores(spark, tmp_path):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 24))
    vectors = [(i, (centres[i % 30] + rng.normal(size=24)).astype(np.float32)) for i in range(3000)]
    same = vectors[5][1]
    vectors = [(i, same if i % 11 == 5 else v) for i, v in vectors]  # one vector on many rows
    rows = [(i, v.tolist()) for i, v in vectors]
    rows += [(5000, None), (5100, [0.0] * 24), (5200, [float("nan")] * 24), (5300, [1.0] * 7), (None, [1.0] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit(1), "score": F.lit("x")})
    got = defaultdict(list)
    for r in queries.op7_nn_descent(spark, tables(tmp_path, embeddings=df)).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = brute_neighbours(vectors)
    assert set(got) == set(want) and all(len(got[q]) == 10 for q in want)
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit / (10 * len(want)) >= 0.95
    true = {(q, i): d for q in want for i, d in want[q]}
    for q in want:
        assert [d for _, d in got[q]] == sorted(d for _, d in got[q])
        assert all(d == pytest.approx(true[q, i], rel=1e-12, abs=1e-12) for i, d in got[q] if (q, i) in true)


@pytest.mark.parametrize("kind", ["outlier", "norms", "huge"])
def test_neighbours_of_rows_with_different_norms(spark, kind, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16))
    if kind == "outlier":
        x[7, 3] = 1e6
    elif kind == "huge":
        x[7, 3], x[9, 2] = 1e30, 1e4
    else:
        x *= 10.0 ** rng.integers(-3, 4, size=(1500, 1))
    vectors = [(i, v) for i, v in enumerate(x.astype(np.float32))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors], "vec_id long, embedding array<float>")
    got = defaultdict(set)
    for r in queries.op7_nn_descent(spark, tables(tmp_path, embeddings=df)).collect():
        got[r.query_id].add(r.vec_id)
    want = brute_neighbours(vectors)
    recall = sum(len(got[q] & {i for i, _ in want[q]}) for q in want) / (10 * len(want))
    assert recall >= 0.95


def test_neighbours_of_doubles_and_large_groups(spark):
    """Double columns keep their precision and range; all ids of a large group of equal vectors can be found, and ids may repeat."""
    rng = np.random.default_rng(8)
    x = 1e60 * (1 + 1e-12 * rng.normal(size=(600, 8)))
    vectors = [(i, x[0] if i % 3 == 0 else v) for i, v in enumerate(x)]
    rows = [(i, v.tolist()) for i, v in vectors] + [(300, x[0].tolist())] * 30 + [(400, x[1].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.search(neighbours.build(df), df.where("vec_id % 100 = 0"), k=25).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score, r["rank"]))
    want = brute_neighbours([*vectors, (1400, x[0])][:600], 25)
    assert [i for i, *_ in got[300]] == [i for i in range(0, 600, 3) if i != 300][:25] and [r for *_, r in got[300]] == list(range(1, 26))
    assert len(got[400]) == 50 and len(got[100]) == 25
    hit = sum(len({i for i, *_ in got[q]} & {i for i, _ in want[q]}) for q in (100, 200, 500))
    assert hit >= 0.9 * 75


def test_neighbours_graph_grows_until_lists_stay(spark):
    """From a poor start too, and over more than 2,048 nodes."""
    x = np.random.default_rng(5).normal(size=(2500, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    index = neighbours.build(df, settings=neighbours.Settings(tables=2, near=1, degree=10, reverse=4, offers=2))
    links = {r.id: set(r.nbrs) for r in index.adjacency.collect()}
    nodes = index.nodes.collect()
    y = np.array([r.vec for r in nodes], dtype=np.float64)
    d = ((y[:, None, :] - y[None, :, :]) ** 2).sum(axis=2)
    near = np.argsort(d, axis=1)[:, 1:6]
    share = np.mean([nodes[j].id in links[nodes[i].id] for i in range(len(nodes)) for j in near[i]])
    assert share >= 0.8


def test_neighbours_of_many_shards_are_those_of_all_rows(spark):
    """Each shard has its own graph and its part of the answer; no shuffle has more than a row for each vector and shard."""
    rng = np.random.default_rng(6)
    vectors = [(i, v) for i, v in enumerate(rng.normal(size=(3000, 16)).astype(np.float32))]
    vectors = [(i, vectors[42][1] if i % 97 == 42 else v) for i, v in vectors]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors], "vec_id long, embedding array<float>")
    index = neighbours.build(df, settings=neighbours.Settings(shard=200))
    assert index.shards == -(-index.nodes.count() // 200) and index.adjacency.count() == index.nodes.count()
    got = defaultdict(list)
    for r in neighbours.search(index, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = brute_neighbours(vectors)
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.95 * 10 * len(want)
    assert all([d for _, d in got[q]] == sorted(d for _, d in got[q]) and len(got[q]) == 10 for q in want)


@pytest.mark.parametrize("n", [0, 1, 4])
def test_neighbours_few_rows(spark, n, tmp_path):
    rows = [(100 * i, [float(i), 1.0]) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = queries.op7_nn_descent(spark, tables(tmp_path, embeddings=df)).collect()
    assert len(got) == n * max(n - 1, 0)


# 8 -------------------------------------------------------------------------------------------------


def brute_classes(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links = [[j for j in range(len(rows)) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j])] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in links[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], min(ids) if ids else None, len(links[i])))
    return Counter(out)


def test_jaccard_join_against_brute_force(spark, nasty, nothing, tmp_path):
    rows, docs = nasty
    got = queries.op8_jaccard_join(spark, tables(tmp_path, documents=docs)).collect()
    assert Counter(map(tuple, got)) == brute_classes(rows)
    assert jaccard_join.classes(nothing).count() == 0


def test_jaccard_join_one_large_group(spark, monkeypatch):
    """Many near copies of one text, dealt over several blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 16)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(80)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(50))) for i in range(40)]
    got = jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id", "n_links").collect()
    assert Counter(map(tuple, got)) == brute_classes(rows)


def test_jaccard_one_of_each(spark, nasty):
    rows, docs = nasty
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[7] == 1 and not ids[8] and not ids[9] and ids[19] == 1 and not ids[20] and ids[1] == ids[11] == 1 and ids[10] == 1


def test_jaccard_one_of_each_of_repeated_and_null_ids(spark):
    base = [f"w{i}" for i in range(60)]
    near = [" ".join(base[:j] + ["x"] + base[j + 1 :]) for j in range(3)]
    other = " ".join(f"o{i}" for i in range(30))
    rows = [(7, near[0]), (7, near[1]), (7, other), (None, other + " more"), (None, "p q r s t u v"), (None, "p q r s t u v"), (8, near[2]), (9, ""), (None, "")]
    kept = Counter((r.doc_id, r.text) for r in jaccard_join.one_of_each(documents(spark, rows)).collect())
    assert sum(n for (_, t), n in kept.items() if t in near) == 1 and not kept[8, near[2]]
    assert kept[7, other] == 1 and not kept[None, other + " more"] and kept[None, "p q r s t u v"] == 1 and kept[9, ""] == kept[None, ""] == 1


def test_bands_meet_the_recall():
    for t in (0.5, 0.8, 0.95):
        b, r = jaccard_join.bands_for(t, 0.99)
        assert 1 - (1 - t**r) ** b >= 0.99 and b * r <= jaccard_join.MAX_HASHES


# 9 -------------------------------------------------------------------------------------------------


def test_edit_counts_equal_a_new_count(spark, nasty, nothing, tmp_path):
    rows, docs = nasty
    got = queries.op9_token_counts(spark, tables(tmp_path, documents=docs)).collect()
    tokenizer = pretokens.word_ids(BPE).tokenizer
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    want = Counter()
    for d, t in plain(rows):
        n = len(t)
        e = t
        for at, cut, ins in ((int(n / 3), 40, ""), (int(n / 2), 0, t[:60]), (int(n * 0.9), 7, " edited words ")):
            at = min(at, len(e))
            e = e[:at] + ins + e[at + cut :]
        want[(d, count(t), count(e), len(e))] += 1
    assert Counter(tuple(r)[:4] for r in got) == want
    none = edit_counts.count_with_edits(docs, F.lit(None), BPE)
    assert none.where("n_tokens != n_tokens_edited").count() == 0
    assert edit_counts.count_with_edits(nothing, F.array(), BPE).count() == 0


def edited_text(text, edits):
    for at, cut, ins in edits:
        at = min(max(at, 0), len(text))
        text = text[:at] + ins + text[at + max(cut, 0) :]
    return text


def test_edit_trees_follow_random_edits():
    words, rng = pretokens.word_ids(BPE), random.Random(2)
    alphabets = ["ab  .\n\té1'sx", "abcdefghijklmnop", "the in an er on 'll 've", "日本語漢字かな😀é", "a1.,;-_'lle re\n\n", "x"]
    for trial in range(900):
        letters = alphabets[trial % len(alphabets)]
        rs = lambda n: "".join(rng.choice(letters) for _ in range(n))  # noqa: E731, B023
        text = rs(rng.randint(0, 900)) if trial % 4 else " ".join(rs(4) for _ in range(300))
        tree = edit_counts.CountTree(words, text)
        for _ in range(5):
            edit = rng.randint(0, len(text) + 3), rng.choice([0, 0, 1, 5, 50, 500]), rs(rng.choice([0, 1, 3, 30, 900]))
            tree.edit(*edit)
            text = edited_text(text, [edit])
            assert tree.text() == text and tree.length == len(text)
            assert tree.tokens == len(words.tokenizer.encode(text, add_special_tokens=False).ids), (trial, text)
            kept = tree.texts, tree.char_sums, tree.token_sums
            tree = edit_counts.CountTree(words, kept=kept)


@pytest.mark.parametrize("kind", ["words", "lines", "letters", "commas", "chinese", "emoji"])
def test_edits_encode_a_part_only(kind):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
    text = {"words": " ".join(word() for _ in range(8000)), "lines": "\n".join(word() for _ in range(5000)), "letters": "".join(word() for _ in range(4000)),
            "commas": ",".join(word() for _ in range(4000)), "chinese": "".join(chr(rng.randint(0x4E00, 0x9FA0)) for _ in range(20_000)), "emoji": "😀🎉é" * 7000}[kind]
    tree = edit_counts.CountTree(pretokens.word_ids(BPE), text)
    tree.edit(15_000, 5, "new")
    assert 0 < tree.encoded < max(0.05 * len(text), 1) and len(tree.texts) > 100
    assert tree.tokens == len(tree.words.tokenizer.encode(edited_text(text, [(15_000, 5, "new")]), add_special_tokens=False).ids)


def test_tree_store_keeps_trees_between_batches(spark, tmp_path):
    """A second session's batches meet the trees of the first, and encode next to nothing."""
    rng = random.Random(5)
    texts = {i: " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 9))) for _ in range(1500)) for i in range(30)} | {40: "", 41: "one"}
    store = edit_counts.TreeStore(spark, str(tmp_path / "trees"), BPE)
    store.build(documents(spark, list(texts.items())))
    tokenizer = pretokens.word_ids(BPE).tokenizer
    for batch in range(2 * edit_counts.FANOUT):
        store = edit_counts.TreeStore(spark, str(tmp_path / "trees"), BPE)
        changes = {d: [(rng.randint(0, len(texts[d])), rng.choice([0, 9]), "edited text")] for d in rng.sample(sorted(texts), 6)}
        rows = [(d, [(*e,) for e in es]) for d, es in changes.items()] + [(999, [(0, 0, "of no document")])]
        got = {r.doc_id: r for r in store.edit(spark.createDataFrame(rows, "doc_id long, edits " + edit_counts.EDITS)).collect()}
        assert set(got) == set(changes)
        texts |= {d: edited_text(texts[d], es) for d, es in changes.items()}
        assert sum(r.n_chars_encoded for r in got.values()) < 0.1 * sum(len(texts[d]) for d in changes)
        assert len(store._tables()) <= edit_counts.FANOUT + 1
    assert {r.doc_id: (r.n_tokens, r.n_chars) for r in store.counts().collect()} == {d: (len(tokenizer.encode(t, add_special_tokens=False).ids), len(t)) for d, t in texts.items()}
    with pytest.raises(ValueError):
        store.build(documents(spark, [(1, "a")]))
    with pytest.raises(ValueError):
        edit_counts.TreeStore(spark, str(tmp_path / "other"), BPE).build(documents(spark, [(1, "a"), (1, "b")]))


# 10 ------------------------------------------------------------------------------------------------


def test_line_dedup_against_sql(spark, nasty, nothing, tmp_path):
    rows, docs = nasty
    folder = tables(tmp_path, documents=docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    got, want = queries.op10_line_dedup(spark, folder).toPandas(), con.sql(queries.SQL["op10_line_dedup"]).df()
    assert rows_of(got) == rows_of(want) and got.n_dropped.sum() > 20
    kept = line_dedup.drop_frequent_lines(docs)
    assert set(kept.columns) == {*docs.columns, "n_dropped"} and kept.schema["n_lines"].dataType.simpleString() == "bigint"
    assert line_dedup.drop_frequent_lines(nothing).count() == 0


def test_line_runs_compact_and_settle(spark):
    runs = line_dedup.LineRuns(spark, min_docs=3, fanout=2)
    counts = Counter()
    for batch in range(5):
        keys = [(k, 0) for k in range(10) for _ in range((k + batch) % 3)]
        counts.update(k for k, _ in keys)
        runs.add(spark.createDataFrame(keys, "h1 long, h2 long"))
    assert len(runs.runs) < 5 and len(runs.levels) > 1
    assert {r.h1 for r in runs.frequent().collect()} == {k for k, n in counts.items() if n >= 3}
    runs.forget()


def test_line_runs_meet_later_sessions(spark, tmp_path):
    """Three tables in turn, each opening the runs of those before; a batch that fails changes nothing."""
    folder = "file://" + str(tmp_path / "runs")
    for part in range(3):
        runs = line_dedup.LineRuns(spark, min_docs=10, folder=folder)
        for name in runs.runs:
            spark.sql(f"DROP TABLE {name}")  # another session knows no tables
        runs = line_dedup.LineRuns(spark, min_docs=10, folder=folder)
        docs = documents(spark, [(100 * part + i, f"shared\nown {part} {i}") for i in range(4)])
        out = line_dedup.drop_frequent_lines(docs, runs=runs).collect()
        assert all(r.n_dropped == (1 if part == 2 else 0) for r in out)
    before = runs.frequent().count(), runs.runs
    with pytest.raises(Exception, match="nothing_like_it"):
        runs.add(docs.select("nothing_like_it"))
    again = line_dedup.LineRuns(spark, min_docs=10, folder=folder)
    assert (again.frequent().count(), again.runs) == before == (1, before[1])
    again.forget()


# Queries -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, small, duck, name):
    assert rows_of(queries.QUERIES[name](spark, small).toPandas()) == rows_of(duck.sql(queries.SQL[name]).df())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert public_tokenizers.path("byte_bpe_50k.json") == BPE
