import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlelake.operators import merge
from articlelake.plans import corpus as jobs
from articlelake.schemas import ARTICLE_SCHEMA, PAGE_SCHEMA
from articlelake.sources import readers, writers
from articlelake.sources.buckets import BucketStore
from articlelake.sources.store import ArticleStore
from articlelake.streaming.ingest import ingest_incremental

from test_pages import as_of, profile, rules


def articles(spark, n=3):
    base = spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("id"),
        F.concat(F.lit("t"), "id").alias("title"),
        F.lit("d").alias("description"),
        F.concat(F.lit("https://a.b/"), "id").alias("url"),
        F.concat(F.lit("p"), F.col("id") % 2).alias("profile"),
        F.lit("S").alias("source"),
        F.lit("2024-01-02 03:04:05").cast("timestamp").alias("publish_date"),
        F.lit("body").alias("formatted_content"),
        F.struct(F.lit(None).cast("array<string>").alias("labels"), F.lit(1).alias("incident")).alias("ml"),
    )
    return merge.align_schema(base, ARTICLE_SCHEMA)


def rows(df):
    return sorted(df.select(F.to_json(F.struct("*"))).collect())


def test_json_roundtrip(spark, tmp_path):
    path = str(tmp_path / "lines")
    writers.write_articles_json(articles(spark), path)
    back = readers.read_articles_json(spark, path)
    assert rows(back) == rows(articles(spark))
    whole = tmp_path / "array.json"
    whole.write_text(json.dumps([json.loads(r[0]) for r in rows(back)]))
    assert rows(readers.read_articles_json(spark, str(whole), array=True)) == rows(back)


def test_backups(spark, tmp_path):
    path = str(tmp_path / "backup")
    found = articles(spark).withColumn("highlights", F.lit("x"))
    writers.write_backup({"main": found, "old": found.limit(1)}, path)
    saved = spark.read.schema(ARTICLE_SCHEMA.add("index", "string")).json(path)
    assert {tuple(r) for r in saved.groupBy("index").count().collect()} == {("main", 3), ("old", 1)}
    assert all("highlights" not in line for line in _gz_lines(path))
    raw = str(tmp_path / "raw")
    docs = spark.createDataFrame([('{"a": [1, {"b": null}]}',)], "value string")
    writers.write_raw_backup(docs, raw)
    assert [r["value"] for r in readers.read_raw_documents(spark, raw).collect()] == ['{"a": [1, {"b": null}]}']


def _gz_lines(path):
    import glob
    import gzip

    for name in glob.glob(f"{path}/**/*.gz", recursive=True):
        with gzip.open(name, "rt") as f:
            yield from f


def test_markdown_export(spark, tmp_path):
    path = str(tmp_path / "md")
    writers.write_markdown(articles(spark), path)
    assert sorted(p for p in os.listdir(path) if p.startswith("profile")) == ["profile=p0", "profile=p1"]
    text = spark.read.parquet(path).filter("profile = 'p1'").first()["markdown"]
    assert text.startswith("# t1\n\n> d\n\n**Source:** S") and text.endswith("\n\nbody")
    single = str(tmp_path / "files")
    writers.write_markdown(articles(spark), single, file_per_article=True)
    assert spark.read.text(single, wholetext=True).count() == 3


def test_bucketed_merge_keeps_the_store_in_place(spark, tmp_path):
    writers.write_bucketed(articles(spark, 20), "bucketed_articles", str(tmp_path / "t"), 4)
    store = spark.table("bucketed_articles")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.join(articles(spark).select("id").repartition(3), "id", "left_anti")
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_articles")


def test_profiles_and_words(spark, tmp_path):
    for name, on in (("a", True), ("b", False)):
        rule = {**profile(name), "enabled": on}
        (tmp_path / f"{name}.json").write_text(json.dumps(rule, indent=1))
    bare = profile("c")
    del bare["enabled"]
    (tmp_path / "c.json").write_text(json.dumps(bare))
    names = lambda df: sorted(r[0] for r in df.select("source.profile_name").collect())
    assert names(readers.read_profiles(spark, str(tmp_path))) == ["a", "c"]
    assert names(readers.read_profiles(spark, str(tmp_path), True)) == ["a", "b", "c"]
    (tmp_path / "words.txt").write_text(" the \nof\nthe\n")
    found = readers.read_word_list(spark, str(tmp_path / "words.txt"))
    assert sorted(r["token"] for r in found.collect()) == ["of", "the"]


RSS = '<?xml version="1.0"?><rss><channel><item><guid isPermaLink="false"> g1 </guid></item><item><guid>g2</guid></item></channel></rss>'
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>a1</id></entry><entry><title>x</title></entry></feed>'
RDF = '<rdf:RDF xmlns:rdf="r"><item rdf:about="d1"><title>t</title></item></rdf:RDF>'


@pytest.mark.parametrize(
    "xml,cap,expected",
    [
        (RSS, 10, [("g1", None), ("g2", None)]),
        (RSS, 1, [("g1", None)]),
        (ATOM, 1, [("a1", None)]),
        (ATOM, 2, [(None, "entry without id")]),
        (RDF, 2, [("d1", None)]),
        ("<rss><channel></channel></rss>", 2, []),
        ("<html></html>", 2, [(None, "not a feed")]),
    ],
)
def test_feed_urls(spark, xml, cap, expected):
    feeds = spark.createDataFrame([("f", xml)], "feed_url string, xml string")
    found = readers.feed_urls(feeds, cap).orderBy("pos").collect()
    assert [(r["url"], r["reason"]) for r in found] == expected


HEADER = "---\nid: one\ntitle: 'It''s: a'\ndescription: \"two\n  lines\"\nsource: The Site\n---\n\n body \n"


def test_markdown_corpus(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.md").write_text(HEADER)
    (tmp_path / "b.md").write_text(HEADER.replace("title", "name"))
    (tmp_path / "c.txt").write_text(HEADER)
    good, bad = readers.read_markdown_corpus(spark, str(tmp_path))
    (row,) = good.collect()
    assert (row["id"], row["title"], row["description"], row["source"], row["image"], row["content"]) == (
        "one", "It's: a", "two lines", "The Site", None, "body"
    )
    assert row["file_path"].endswith("sub/a.md")
    assert [r["errors"] for r in bad.collect()] == [["title is missing"]]
    raw = readers.read_markdown_raw(spark, str(tmp_path / "sub" / "a.md")).collect()
    assert [r["content"] for r in raw] == [HEADER]


def test_corpus_load_and_delete(spark, tmp_path):
    (tmp_path / "a.md").write_text(HEADER)
    good, _ = readers.read_markdown_corpus(spark, str(tmp_path))
    start, end = (F.lit(d).cast("timestamp") for d in ("2024-01-01", "2024-02-01"))
    once = jobs.load_corpus(articles(spark), good, start, end)
    assert once.count() == 4 and rows(jobs.load_corpus(once, good, start, end)) == rows(once)
    made = once.filter("source = 'The Site'").first()
    assert (made["profile"], made["author"], made["image_url"]) == ("thesite", "The Site", "")
    assert made["publish_date"] == made["inserted_at"]
    assert rows(jobs.delete_corpus(once, good)) == rows(articles(spark))


def test_backfilled_header_parses(spark):
    files = spark.createDataFrame([("/x/My file.md", "text: 'a'\n")], "path string, content string")
    sources = spark.createDataFrame([("S1",), ("S2",)], "source string")
    about = spark.createDataFrame([("/x/My file.md", "it's")], "path string, description string")
    filled = jobs.backfill_headers(files, sources, about)
    good, _ = readers.parse_markdown(jobs.with_header(filled))
    row = good.first()
    assert (row["title"], row["description"], row["content"]) == ("My file", "it's", "text: 'a'")
    assert row["id"] == filled.first()["id"] and row["source"] in ("S1", "S2")


def test_import(spark):
    batch = articles(spark, 5).unionByName(articles(spark, 5).withColumn("url", F.lit(None).cast("string")).limit(1))
    good, rejected = jobs.import_articles(batch, articles(spark, 3), as_of())
    assert sorted(r["url"] for r in good.collect()) == ["https://a.b/3", "https://a.b/4"]
    assert [r["reason"] for r in rejected.collect()] == ["no url"]


def test_store(spark, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "s"))
    assert store.read().count() == 0 and store.version == 0
    assert store.append(articles(spark, 2), "first") == 1
    published = {p: p.stat().st_mtime_ns for p in (tmp_path / "s").glob("first*/*")}
    assert store.append(articles(spark, 3), "first") == 2 and store.read().count() == 3
    assert published == {p: p.stat().st_mtime_ns for p in published}
    assert store.read(without="first").count() == 0
    assert store.replace(store.read().filter("title <> 't0'")) == 3
    assert sorted(r["title"] for r in store.read().collect()) == ["t1", "t2"]
    assert store.read(without="first").count() == 2
    ids = articles(spark, 2).select("id")
    store.replace(merge.delete_by_id(store.read(), ids))
    assert [r["title"] for r in store.read().collect()] == ["t2"] and store.version == 4


def test_unreadable_dates(spark):
    found = spark.createDataFrame([("1", "soon", "2024-01-02"), ("2", None, "2024-01-02T03:04:05+01:00")], "id string, publish_date string, inserted_at string")
    assert [tuple(r) for r in jobs.unreadable_dates(found).collect()] == [("1", "publish_date", "soon")]
    good, rejected = jobs.add_timezone(found)
    assert good.count() + 1 == found.count() and dict(good.dtypes)["publish_date"] == "timestamp"
    assert [(r["id"], r["publish_date"], r["reason"]) for r in rejected.collect()] == [("1", "soon", "publish_date is not a date")]
    assert [r["id"] for r in jobs.modified_dates(found).collect()] == ["1"]


def test_ingest(spark, tmp_path):
    body = '<meta name="description" content="d"><h1>T</h1><article><p>x</p></article>'

    def arrive(*numbers):
        found = [(i, f"https://a.b/{i}", body if i else "<p>bad", 200 if i != 9 else 500) for i in numbers]
        spark.createDataFrame(found, PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/pages")

    store = ArticleStore(spark, f"{tmp_path}/store")

    def run(checkpoint="c"):
        ingest_incremental(
            spark, f"{tmp_path}/pages", PAGE_SCHEMA, rules(spark, profile()), ["the"], store,
            f"{tmp_path}/{checkpoint}", as_of(), rejects_dir=f"{tmp_path}/rejects",
        )
        return sorted(r["url"][-1] for r in store.read().collect())

    arrive(0, 1, 2, 9)
    assert run() == ["1", "2"]
    arrive(2, 3)
    assert run() == ["1", "2", "3"]
    # A new stream over the same files finds everything stored.
    assert run("other") == ["1", "2", "3"]
    rejects = spark.read.parquet(f"{tmp_path}/rejects/*")
    assert rejects.filter("url like '%/0'").count() >= 1
    assert rejects.filter("url like '%/9' and array_contains(errors, 'status 500')").count() >= 1


def test_bucket_store_rewrites_only_touched_buckets(spark, tmp_path):
    shape = T.StructType.fromDDL("id string, title string, seq int")
    store = BucketStore(spark, str(tmp_path / "b"), shape, buckets=8, files=2)
    store.create(spark.createDataFrame([(str(i), f"t{i}", 0) for i in range(100)], shape))
    files = lambda: {p for p in (tmp_path / "b").rglob("*.parquet")}
    before = files()
    touched = store.upsert(spark.createDataFrame([("7", "new", 1), ("7", "old", 0), (None, "x", 1)], shape), ["seq"])
    assert len(touched) == 1
    kept = before & files()
    assert len(kept) > len(before) / 2 and {p.parent.name for p in before - kept} == {f"__bucket={touched[0]}"}
    store.update_fields(spark.createDataFrame([("8", None), ("none", "y")], "id string, title string"), ["title"])
    rows = {r["id"]: r["title"] for r in store.read().collect()}
    assert len(rows) == 100 and rows["7"] == "new" and rows["8"] is None and rows["9"] == "t9"
    # Buckets may lose all their rows.
    store.delete(spark.createDataFrame([(str(i),) for i in range(99)] + [("q",)], "id string"))
    assert [r["id"] for r in store.read().collect()] == ["99"]
    assert store.delete(spark.createDataFrame([], "id string")) == [] and store.read().count() == 1
    assert store.read().columns == ["id", "title", "seq"]
