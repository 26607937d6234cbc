"""The pipeline's stages, each against a plain version on what the stage before it kept."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from planquill.llm import quality
from planquill.llm._common import stored, table

from .test_operators import brute_classes, brute_pii


def test_stages(spark, small):
    docs = table(spark, small, "documents")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    model = quality.train(docs, table(spark, small, "labels"))
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, small), name)
        after = {r.doc_id: r for r in docs.collect()} if name != "packing" else None
        if after is not None:
            assert docs.columns == columns and all(r.n_chars == len(r.text) for r in after.values() if r.text != before[r.doc_id].text)
        if name == "quality":
            assert set(after) == {d for d, r in before.items() if model.score(r.text or "") >= quality.ACCEPT}
        elif name == "line_dedup":
            found = Counter(k for r in before.values() for k in {line.strip(" \t\n\x0b\x0c\r").lower() if line.isascii() else None for line in r.text.split("\n")})
            for d, r in after.items():
                want = [x for x in before[d].text.split("\n") if not x.isascii() or not x.strip() or found[x.strip(" \t\n\x0b\x0c\r").lower()] < 10]
                assert r.text.split("\n") == want or not before[d].text.isascii()
        elif name == "near_duplicates":
            want = brute_classes([(d, r.text) for d, r in before.items()])
            assert set(after) == {d for d, c, _ in want if d == c}
        elif name == "pii":
            assert set(after) == set(before)
            for d, r in after.items():
                assert not brute_pii(r.text) and (brute_pii(before[d].text) or r.text == before[d].text)
        if after is not None:
            before = after
    assert {r.doc_id for r in docs.collect()} == set(before)


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "pii", "packing"]


def test_stages_on_odd_and_empty_tables(spark, nasty, nothing, tmp_path):
    """Nulls, long texts, repeated rows and clashing names pass through every stage; so does nothing at all."""
    rows, odd = nasty
    labels = spark.createDataFrame([(7, 1, 0), (100, 1, 0), (101, 1, 1), (None, 0, 0), (102, None, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd, nothing):
        kept = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stored(stage(spark, kept, str(tmp_path)), f"odd-{name}")
            assert kept.columns == docs.columns
        ids = [r.doc_id for r in kept.collect()]
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path))
        assert {r.doc_id for r in packed.collect()} == set(ids)
        if docs is odd:
            # Every text is clean by these labels: copies alone go.
            assert 7 in ids and 8 not in ids and 9 not in ids and 20 not in ids and ids.count(7) == 1 and 12 in ids
