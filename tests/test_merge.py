import math
import unicodedata
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from articlelake.functions import models, weights
from articlelake import session
from articlelake.operators import corpus, labels, merge, quality
from articlelake.plans import corpus as jobs
from articlelake.schemas import ARTICLE_SCHEMA
from articlelake.session import scratch_dir


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def as_set(df):
    return set(map(tuple, df.collect()))


STORE = "id string, url string, title string, inserted_at int"


@pytest.fixture(params=["small", "large"])
def size(request, monkeypatch):
    """Run joins both ways: with a broadcast batch and with a shuffled one."""
    if request.param == "large":
        monkeypatch.setattr(merge, "fits_broadcast", lambda df: False)
        monkeypatch.setattr(merge, "broadcast_if_bounded", lambda df: df)


def store(spark):
    return table(spark, STORE, ("a", "u1", "A", 1), ("b", "u2", "B", 1), ("c", "u3", "C", 1))


def test_presence_partitions_the_batch(spark, size):
    batch = table(spark, "url string", ("u1",), ("u9",), ("u3",), ("u3",), (None,))
    found = merge.already_stored(batch, store(spark)).collect()
    fresh = merge.not_stored(batch, store(spark)).collect()
    assert sorted(r["url"] for r in found) == ["u1", "u3", "u3"]
    assert sorted(str(r["url"]) for r in fresh) == ["None", "u9"]


def test_small_batch_leaves_the_store_in_place(spark, sf):
    stored = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("source", "url")
    plan = merge.not_stored(table(spark, "url string", ("u1",)), stored)._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan.split("== Physical Plan ==")[1]


def test_large_batch_keeps_wide_rows_out_of_the_search(spark, sf, monkeypatch):
    stored = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("source", "url")
    batch = spark.read.parquet(f"{sf}/pages.parquet")
    answers = iter([False])
    monkeypatch.setattr(merge, "fits_broadcast", lambda df: next(answers))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merge.not_stored(batch, stored)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    top = plan.split("SortMergeJoin")[0]
    assert "BroadcastHashJoin" in top and "Exchange hashpartitioning" not in top.split("FileScan")[0]


def test_new_articles(spark, size):
    batch = table(spark, STORE, ("x", "u1", "X", 1), ("y", "u8", "old", 1), ("z", "u8", "new", 2), ("w", None, "W", 1))
    fresh, rejected = merge.new_articles(batch, store(spark))
    assert [r["title"] for r in fresh.collect()] == ["new"]
    assert [(r["title"], r["reason"]) for r in rejected.collect()] == [("W", "no url")]


def test_upsert(spark, size):
    batch = table(spark, STORE, ("a", "u1", "older", 5), ("a", "u1", "newer", 6), ("d", "u4", "D", 1))
    once = merge.upsert(store(spark), batch)
    assert {(r["id"], r["title"]) for r in once.collect()} == {
        ("a", "newer"), ("b", "B"), ("c", "C"), ("d", "D")
    }
    assert as_set(merge.upsert(once, batch)) == as_set(once)


def test_hot_key_is_cut_before_the_shuffle(spark):
    plan = merge.latest_per_key(store(spark), "id", ["inserted_at"])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_update_fields(spark, size):
    batch = table(spark, "id string, title string, url string", ("a", None, "no"), ("zz", "no", "no"))
    changed = merge.update_fields(store(spark), batch, ["title"])
    assert as_set(changed) == {("a", "u1", None, 1), ("b", "u2", "B", 1), ("c", "u3", "C", 1)}


def test_last_row_of_a_key_counts(spark, size):
    shape = "id string, seq int, m map<string,double>"
    old = table(spark, "id string, m map<string,double>", ("a", {"o": 1.0}), ("b", {"o": 2.0}), ("c", None))
    batch = table(spark, shape, ("a", 1, {"x": 9.0}), ("a", 3, {"y": 1.0}), ("a", 2, {"z": 5.0}), ("b", 7, None), ("b", None, {"q": 1.0}))
    changed = merge.update_fields(old, batch, ["m"], order=["seq"])
    assert {r["id"]: r["m"] for r in changed.collect()} == {"a": {"y": 1.0}, "b": None, "c": None}
    with pytest.raises(Exception, match="no order for the rows of key a"):
        merge.update_fields(old, batch, ["m"]).collect()
    decisions = table(spark, "id string, choice string, at int", ("a", "6", 1), ("a", "0", 2), ("a", "x", 3), ("b", "3", 1))
    done, rejected = labels.apply_labels(judged(spark), decisions, order=["at"])
    assert {r["id"]: r["ml"] and r["ml"]["labels"] for r in done.collect()} == {"a": ["trends"], "b": ["research"], "c": None}
    assert rejected.count() == 1


def test_corrections_by_order(spark):
    rules = {"title": [("is required", F.coalesce(F.col("title") != "", F.lit(False)))]}
    bad = quality.validate(table(spark, "id string, title string", ("1", None), ("2", ""), ("3", "t")), rules)[1]
    fixes = table(
        spark, "id string, field string, new_value string, at int",
        ("1", "title", "z", 1), ("1", "title", "a", 2), ("2", "title", "good", 1), ("2", "title", "", 2), ("1", "odd", "x", 1), ("9", "title", "x", 1),
    )
    good, still = quality.apply_corrections(bad, fixes, fixes.limit(0), rules, ["title"], order=["at"])
    assert as_set(good) == {("1", "a")} and [r["id"] for r in still.collect()] == ["2"]
    unused = quality.unused_corrections(bad, fixes, ["title"])
    assert {(r["id"], r["reason"]) for r in unused.collect()} == {("1", "not a field to correct"), ("9", "no such row")}
    with pytest.raises(Exception, match="no order for the fixes of title"):
        quality.apply_corrections(bad, fixes, fixes.limit(0), rules, ["title"])[0].collect()


def test_delete(spark, size):
    gone = table(spark, "id string", ("a",), ("a",), ("q",))
    assert {r["id"] for r in merge.delete_by_id(store(spark), gone).collect()} == {"b", "c"}


def test_rekey(spark, size):
    ids = [r["m"] for r in table(spark, "u string", ("u1",), ("u2",)).select(F.md5("u").alias("m")).collect()]
    # The first article sits under the id that belongs to the second.
    mixed = table(
        spark, STORE, (ids[1], "u1", "one", 1), ("old", "u2", "two", 1), ("older", "u2", "two again", 2)
    )
    once = merge.rekey(mixed)
    assert {(r["id"], r["title"]) for r in once.collect()} == {(ids[0], "one"), (ids[1], "two again")}
    assert as_set(merge.rekey(once)) == as_set(once)


def test_copy_fields(spark, size):
    source = table(spark, "url string, title string", ("u1", "new"), ("u7", "lost"))
    changed, absent = merge.copy_fields(source, store(spark), ["title"])
    assert ("a", "u1", "new", 1) in as_set(changed) and changed.count() == 3
    assert as_set(absent) == {("u7",)}


def test_align_schema(spark):
    old = spark.createDataFrame(
        [Row(id="1", embeddings=Row(content_chunks=[Row(text="t")]), own=1)],
        "id string, embeddings struct<content_chunks:array<struct<text:string>>>, own int",
    )
    new = merge.align_schema(old, ARTICLE_SCHEMA)
    assert new.columns == [*ARTICLE_SCHEMA.fieldNames(), "own"]
    row = new.first()
    assert row["embeddings"]["content_chunks"][0]["elser"] is None and row["tags"] is None
    assert merge.align_schema(new, ARTICLE_SCHEMA).schema == new.schema


def test_broadcast_bounds(spark):
    rows = spark.range(100)
    assert session.fits_broadcast(rows)
    assert not session.fits_broadcast(rows, max_rows=99)
    assert not session.fits_broadcast(rows, max_bytes=100)


DOCS = "id string, title string, description string, url string, publish_date string"


def test_validate_and_correct(spark):
    docs = table(
        spark, DOCS,
        ("1", "t", "d", "https://a.b", "2024-01-01"), ("2", "", "d", "https://a.b", "2024-01-01"),
        ("3", "t", None, "ftp://x", "never"), ("4", None, "d", "https://a.b", None),
        ("5", "t", "d", "https://a.b", "2999-01-01"),
    )
    rules = quality.article_rules(F.lit("2024-06-01").cast("timestamp"))
    good, bad = quality.validate(docs, rules)
    assert [r["id"] for r in good.collect()] == ["1"]
    errors = {r["id"]: [tuple(e) for e in r["errors"]] for r in bad.collect()}
    assert errors["3"] == [
        ("description", "is required"), ("url", "is not an http address"), ("publish_date", "is not a date")
    ]
    assert errors["5"] == [("publish_date", "is in the future")]
    fixes = table(
        spark, "id string, field string, new_value string",
        ("2", "title", "T2"), ("3", "url", "https://c.d"), ("4", "title", "T4"), ("4", "publish_date", "2024-01-01"),
    )
    fixed, still = quality.apply_corrections(
        bad, fixes, table(spark, "id string", ("5",)), rules, ["title", "url", "publish_date"]
    )
    assert {(r["id"], r["title"]) for r in fixed.collect()} == {("2", "T2"), ("4", "T4")}
    assert [r["id"] for r in still.collect()] == ["3"]


def test_references(spark):
    profiles = spark.createDataFrame(
        [Row(source=Row(profile_name="p"), scraping=Row(js_injections=["a", "b"]))]
    )
    files = table(spark, "name string", ("a",))
    assert as_set(quality.missing_references(profiles, files)) == {("p", "b")}
    with pytest.raises(Exception, match="b not found"):
        quality.missing_references(profiles, files, strict=True).collect()


def test_reports(spark):
    profiles = table(spark, "profile string", ("b",), ("a",), ("c",))
    results = table(spark, "profile string, url string, ok boolean", ("a", "1", True), ("a", "2", False), ("b", "3", None))
    assert [tuple(r) for r in quality.url_counts(profiles, results).collect()] == [("a", 2), ("b", 1), ("c", 0)]
    assert [tuple(r) for r in quality.parse_success(profiles, results).collect()] == [
        ("a", 1, 1), ("b", 0, 1), ("c", 0, 0)
    ]
    assert quality.any_left(results) and not quality.any_left(results.limit(0))


@pytest.mark.parametrize(
    "choice,names",
    [
        ("", ["none"]), ("0,3", ["trends", "research"]), (" 6", ["malware"]),
        ("7", None), ("-1", None), ("x", None), ("0,", None),
    ],
)
def test_label_names(one, choice, names):
    assert one(labels.label_names, c=choice) == names


ML = "id string, title string, publish_date string, ml struct<labels:array<string>,incident:int>"


def judged(spark):
    return table(
        spark, ML, ("a", "A", "3", (["apt"], 0)), ("b", "B", "2", ([], 1)), ("c", "C", "1", None)
    )


def test_queues(spark):
    assert [r["id"] for r in labels.label_queue(judged(spark)).collect()] == ["b", "c"]
    assert [r["id"] for r in labels.label_queue(judged(spark), 2).collect()] == ["b"]
    assert [r["id"] for r in labels.label_queue(judged(spark), 2, filter_first=True).collect()] == ["b", "c"]
    assert [r["id"] for r in labels.incident_queue(judged(spark)).collect()] == ["a"]


def test_decisions(spark):
    done, rejected = labels.apply_labels(
        judged(spark), table(spark, "id string, choice string", ("b", "4,6"), ("c", ""), ("a", "9"))
    )
    got = {r["id"]: r["ml"] and (r["ml"]["labels"], r["ml"]["incident"]) for r in done.collect()}
    assert got == {"a": (["apt"], 0), "b": (["apt", "malware"], 1), "c": (["none"], 0)}
    assert [r["id"] for r in rejected.collect()] == ["a"]
    done = labels.apply_incident(
        judged(spark), table(spark, "id string, is_incident boolean", ("a", True), ("b", False))
    )
    got = {r["id"]: r["ml"] and r["ml"]["incident"] for r in done.collect()}
    assert got == {"a": 2, "b": 1, "c": None}


def chunks(*texts):
    return [(t, {"stale": 1.0}) for t in texts]


def test_vectors(spark):
    rows = [
        ("1", "red car", "fast car", "u", ((None,), (None,), chunks("car car", "red"))),
        ("2", "blue", "sky", "u", None),
    ]
    schema = (
        "id string, title string, description string, url string, embeddings struct<"
        "title:struct<elser:map<string,float>>,description:struct<elser:map<string,float>>,"
        "content_chunks:array<struct<text:string,elser:map<string,float>>>>"
    )
    articles = spark.createDataFrame(rows, schema)
    got = {r["id"]: r["embeddings"] for r in corpus.sparse_embed(articles).collect()}
    first = got["1"]["content_chunks"][0]["elser"]
    assert set(first) == {"car"} and set(got["1"]["title"]["elser"]) == {"red", "car"}
    assert first["car"] == pytest.approx(2 * got["1"]["title"]["elser"]["car"])
    assert got["2"]["content_chunks"] is None and set(got["2"]["title"]["elser"]) == {"blue"}

    def model(t):
        return F.create_map(t, F.length(t).cast("float"))

    got = {r["id"]: r["embeddings"] for r in corpus.sparse_embed(articles, model).collect()}
    assert [c["elser"] for c in got["1"]["content_chunks"]] == [{"car car": 7.0}, {"red": 3.0}]
    assert got["2"]["title"]["elser"] == {"blue": 4.0} and got["2"]["content_chunks"] is None


def odd_articles(spark):
    def vectors(*texts):
        return ((None,), (None,), [(t, None) for t in texts])

    twice = ("1", "red car", "fast car", vectors("car car", "", None, "red", "'x", "— é car"))
    rows = [twice, twice, ("1", "other", None, vectors()), (None, None, None, None), (None, "", "", vectors("", None))]
    schema = (
        "id string, title string, description string, embeddings struct<"
        "title:struct<elser:map<string,float>>,description:struct<elser:map<string,float>>,"
        "content_chunks:array<struct<text:string,elser:map<string,float>>>>"
    )
    return spark.createDataFrame(rows, schema).repartition(2)


def own_models():
    def load():
        return lambda texts: [{w: float(t.split().count(w)) for w in t.split()} for t in texts]

    whole = models.model_weigher(load)
    return whole, lambda t: whole(t)


def test_vectors_of_odd_articles(spark):
    for model in (None, *own_models()):
        got = corpus.sparse_embed(odd_articles(spark), model).collect()
        assert sorted(str(r["title"]) for r in got) == ["", "None", "other", "red car", "red car"]
        for r in got:
            e = r["embeddings"]
            if r["title"] == "red car":
                chunks = [c["elser"] for c in e["content_chunks"]]
                assert set(e["title"]["elser"]) == {"red", "car"} and chunks[2] is None and chunks[1] == {}
                assert set(chunks[0]) == {"car"} and set(chunks[3]) == {"red"} and "car" in chunks[5]
            elif r["title"] is None:
                assert e["title"]["elser"] is None and e["content_chunks"] is None
            elif r["title"] == "":
                assert e["title"]["elser"] == {} and [c["elser"] for c in e["content_chunks"]] == [{}, None]


def exchanged(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_vectors_move_little(spark):
    """A model's vectors stay in the article's row; an article without a model moves once, its words as pairs once each way."""
    assert exchanged(corpus.sparse_embed(odd_articles(spark), own_models()[0])) == 0
    assert exchanged(corpus.sparse_embed(odd_articles(spark), own_models()[1])) == 1
    assert exchanged(corpus.sparse_embed(odd_articles(spark))) <= 4


def test_articles_without_a_model_move_once(spark):
    """Words move once a block to their frequencies; back they come with the articles."""
    assert exchanged(corpus.sparse_embed(odd_articles(spark))) == 2


def worded_articles(spark):
    words = ["car", "red", "sky", "é", "blue"]

    def line(i):
        return " ".join([words[i % 5], words[i * i % 5], f"w{i // 3}", f"only{i}", words[i % 2]])

    rows = [(str(i % 7), line(i), None if i % 4 else "sky", ((None,), (None,), chunks(line(i + 9), line(i)))) for i in range(50)]
    return spark.createDataFrame(rows, odd_articles(spark).schema).repartition(3)


def test_vectors_of_many_blocks(spark, monkeypatch):
    for bits in (1, 13):
        monkeypatch.setattr(corpus, "BLOCK_BITS", bits)
        articles = worded_articles(spark)
        texts = [t.split() for r in articles.collect() for t in (r["title"], r["description"], *(c["text"] for c in r["embeddings"]["content_chunks"])) if t]
        df = Counter(w for t in texts for w in {unicodedata.normalize("NFKD", w) for w in t})
        assert min(df.values()) == 1 < max(df.values())
        got = corpus.sparse_embed(articles).collect()
        assert len(got) == 50
        for r in got:
            e = r["embeddings"]
            pairs = [(r["title"], e["title"]["elser"]), *((c["text"], c["elser"]) for c in e["content_chunks"])]
            for text, vector in pairs:
                n = Counter(unicodedata.normalize("NFKD", text).split())
                assert vector == pytest.approx({w: k * (math.log((len(texts) + 1) / (df[w] + 1)) + 1) for w, k in n.items()})
            assert (e["description"]["elser"] is None) == (r["description"] is None)


@pytest.mark.parametrize("held", [1, 1000])
def test_words_are_counted_by_block(monkeypatch, held):
    monkeypatch.setattr(weights, "HELD_WORDS", held)
    def batch(blocks, *texts):
        return pa.record_batch([pa.array(blocks, pa.int64()), pa.array(texts, pa.list_(pa.string()))], names=["b", "t"])

    rows = batch([1, 1], ["a  b a", None], ["b", ""]), batch([1, 2, 3], ["b c"], ["a", "a"], [None])
    got = [r for b in weights.count_words(iter(rows)) for r in b.to_pylist()]
    total = Counter()
    for r in got:
        total[r["block"], r["token"]] += r["n"]
    assert total == {(1, "a"): 1, (1, "b"): 3, (1, "c"): 1, (2, "a"): 2}
    assert held == 1 or len(got) == 4


def test_neither_words_nor_stale_vectors_are_written(spark, monkeypatch):
    paths = []
    monkeypatch.setattr(corpus, "scratch_dir", lambda s, name: paths.append(scratch_dir(s, name)) or paths[-1])
    corpus.sparse_embed(odd_articles(spark))
    (written,) = [spark.read.parquet(p).schema for p in paths]
    assert "map<" not in written.simpleString() and "n:int" not in written.simpleString()


def test_model_weigher(spark):
    def load():
        return lambda texts: [{t: len(t), "all": len(texts)} for t in texts]

    texts = spark.createDataFrame([("ab",), (None,), ("",)], "t string").coalesce(1)
    got = [r["v"] for r in texts.select(models.model_weigher(load)(F.col("t")).alias("v")).collect()]
    assert got[1] is None and got[0] == {"ab": 2.0, "all": 2.0} and got[2] == {"": 0.0, "all": 2.0}


def test_regenerated_tags(spark):
    stored = merge.align_schema(
        table(spark, "id string, content string", ("1", "odd odd odd T1059.001")), ARTICLE_SCHEMA
    )
    row = jobs.regenerate_tags(stored, []).first()
    assert row["tags"]["automatic"] == ["odd"] and row["tags"]["interesting"][0]["name"] == "MITRE IDs"


def test_keys_are_worked_out_once(spark):
    """Keys of a delete may come of whole files; each is read once for them."""
    from pyspark.sql import types as T

    seen = spark.sparkContext.accumulator(0)

    def noted(value):
        seen.add(1)
        return value

    ids = spark.createDataFrame([("a",), ("c",), (None,), ("c",)], "id string")
    ids = ids.select(F.udf(noted, T.StringType()).asNondeterministic()("id").alias("id"))
    store = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    got = [r["id"] for r in merge.delete_by_id(store, ids).collect()]
    assert sorted(got, key=str) == [None, "b", "b"] and seen.value == 4
