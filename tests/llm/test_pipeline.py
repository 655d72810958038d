"""The pipeline against its stages done plainly."""

import zlib

import brute
import corpus_pipeline
import numpy as np
from tokenizers import Tokenizer

from articlelake.llm import langid, mixing, tokens


def test_pipeline(spark, sf, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    model = langid.learn(docs.filter(~langid.held_out(docs["doc_id"])), "doc_id", "text", "lang")
    known = {r["doc_id"] for r in langid.identify(docs, model).collect() if r["lang_pred"] != "und" and r["score"] >= 0.5}
    rows = [r for r in rows if r[0] in known]
    groups = brute.near_components(rows)
    rows = [r for i, r in enumerate(rows) if groups[i][1] == r[0] or not groups[i][0]]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    found = brute.hits(rows, items)
    rows = [r for i, r in enumerate(rows) if not found[i][1]]
    left = docs.join(spark.createDataFrame([(r[0],) for r in rows], "doc_id long"), "doc_id")
    times = {r["doc_id"]: -(-r["taken"] // r["size"]) if r["size"] else 0 for r in mixing.mix(left).documents().collect()}
    tokenizer, start, want = Tokenizer.from_file(tokens.word_tokenizer()), 0, []
    for key, text in sorted(rows):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        for _ in range(times[key]):
            want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    got = sorted((tuple(r) for r in corpus_pipeline.run(spark, sf).collect()), key=lambda r: r[1])
    assert got == want


def test_stages_take_odd_rows(spark, sf, odd, none):
    for table in (odd, none):
        rows = table
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, sf)
            assert rows.columns in (odd.columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
        rows.collect()


def test_mixing_follows_its_schedule(monkeypatch, docs):
    """What the schedule leaves out is not in the mixed rows, and the stage changes what is encoded."""
    all_rows = mixing.mixed_rows(docs).count()
    assert all_rows > docs.count()
    whole = mixing._schedule
    monkeypatch.setattr(mixing, "_schedule", lambda *a: whole(*a).filter("rank = 0"))
    assert 0 < mixing.mixed_rows(docs).count() < all_rows
