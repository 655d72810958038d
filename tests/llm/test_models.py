"""Language and toxicity models: held-out quality, exact labelling and odd rows."""

import numpy as np

from articlelake.llm import langid, toxicity


def test_viterbi_is_exact(monkeypatch):
    monkeypatch.setattr(langid, "_STRETCH", 5)
    rng = np.random.default_rng(1)
    for _ in range(50):
        bounds = np.append(0, np.cumsum(rng.integers(0, 23, rng.integers(1, 5))))
        scores = rng.normal(0, 3, (bounds[-1], 3)).astype(np.float32)
        labels = langid.best_labels(scores, bounds, 2.0)
        for a, b in zip(bounds, bounds[1:], strict=False):
            if a == b:
                continue
            best = scores[a].astype(float)
            for row in scores[a + 1 : b]:
                best = np.maximum(best, best.max() - 2.0) + row
            own = labels[a:b]
            value = scores[a:b][np.arange(b - a), own].sum() - 2.0 * (np.diff(own) != 0).sum()
            assert abs(value - best.max()) < 1e-3


def test_languages(spark, docs, odd, none):
    found = langid.train_and_identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    rows = found.collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    model = langid.learn(docs, "doc_id", "text", "lang")
    mixed = docs.filter("lang = 'en'").first()["text"][:400] + "\n" + docs.filter("lang = 'de'").first()["text"][:400]
    spans = langid.identify(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()["spans"]
    assert [s["lang"] for s in spans][:1] == ["en"] and spans[-1]["lang"] == "de" and spans[-1]["end"] <= len(mixed)
    got = langid.identify(odd, model).collect()
    assert len(got) == odd.count()
    for r in got:
        if r["doc_id"] in (4, 5, 6):
            assert (r["lang_pred"], r["score"], r["spans"]) == ("und", 0.0, [])
        if r["doc_id"] == 10:
            assert r["lang_pred"] in model.languages
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = langid.keep_known(odd, model)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()}.isdisjoint({4, 5, 6})
    assert langid.train_and_identify(none).isEmpty()
    assert set(r["lang_pred"] for r in langid.identify(odd, langid.learn(none, "doc_id", "text", "lang")).collect()) == {"und"}


def test_toxicity(spark, docs, odd, none):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.train_and_score(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    toxic = np.array([r["score"] for r in found if r["toxic"] == 1])
    clean = np.array([r["score"] for r in found if r["toxic"] == 0])
    assert (toxic[:, None] > clean[None]).mean() > 0.8
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in found)
    model = toxicity.learn(docs, labels, "doc_id", "text", "toxic")
    misspelt = spark.createDataFrame([(1, "you idi0t and stupidd worthles"), (2, "the of and to in")], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(misspelt, model).collect()}
    assert scores[1] > 0.5 > scores[2]
    got = toxicity.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (4, 5, 6))
    assert toxicity.train_and_score(none, labels).isEmpty()
    unlabelled = toxicity.train_and_score(odd, labels.limit(0)).collect()
    assert all(r["predicted"] == 0 for r in unlabelled if r["doc_id"] == 5)


def test_viterbi_with_many_labels():
    """Labels beyond 127 are switched to and from."""
    want = np.array([150, 199, 3, 128, 128, 199])
    scores = np.full((len(want), 200), -50.0, np.float32)
    scores[np.arange(len(want)), want] = 0.0
    assert langid.best_labels(scores, np.array([0, 4, 6]), 1.0).tolist() == want.tolist()
