import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from articlelake.functions import dates, indicators, text, urls
from articlelake.operators import corpus


@pytest.mark.parametrize(
    "url,ok",
    [
        ("https://a.b", True),
        ("http://a/b.c", True),
        ("ftp://a.b", False),
        ("/x.y", False),
        ("http://localhost", False),
    ],
)
def test_is_valid_url(one, url, ok):
    assert one(urls.is_valid_url, u=url) is ok


@pytest.mark.parametrize(
    "root,target,out",
    [
        ("https://a.b/", "/c", "https://a.b/c"),
        ("https://a.b", "/c", "https://a.b/c"),
        ("https://a.b", "c", "https://a.b/c"),
        ("https://a.b/", "https://x.y/z", "https://x.y/z"),
    ],
)
def test_resolve_url(one, root, target, out):
    assert one(urls.resolve_url, r=root, t=target) == out


def test_ids_and_slugs(one):
    assert one(urls.article_id, u="https://a.é") == hashlib.md5("https://a.é".encode()).hexdigest()
    assert one(urls.profile_slug, s="The Daily News") == "thedailynews"
    assert one(urls.site_icon, a="https://a.b/") == "https://a.b/favicon.ico"
    assert one(urls.site_icon, a="https://a.b") == "https://a.b/favicon.ico"
    assert one(urls.url_host, u="https://m.A.example.net/en/25#top") == "m.a.example.net"


def test_page_urls(one):
    got = one(lambda t: urls.page_urls(t, 2, 5), t="https://a.b/p/%")
    assert got == [f"https://a.b/p/{n}" for n in range(2, 7)]
    with pytest.raises(Exception, match="page number"):
        one(lambda t: urls.page_urls(t, 2, 5), t="https://a.b/p/")


@pytest.mark.parametrize(
    "raw,clean",
    [
        ("ﬁne １ a–b\nc", "fine 1 a-b c"),
        ("café", "café"),
        ("plain", "plain"),
        ("﹘﹣－⸺", "----"),
    ],
)
def test_clean_text(one, raw, clean):
    assert one(text.clean_text, t=raw) == clean


def test_clean_texts(one):
    got = one(lambda t: text.clean_texts(F.split(t, ";")), t="①;b\nc")
    assert got == ["1", "b c"]


@pytest.mark.parametrize(
    "raw,words",
    [
        ("don't do it", ["don", "do", "it"]),
        ("a {x} b {y} c", ["a", "c"]),
        ("a 123 b", ["a", "b"]),
        ("a αβ b", ["a", "b"]),
        ("Say “Hi\" (now), ok: yes", ["say", "hi", "now", "ok", "yes"]),
        ("tab\tand\x0bmore here", ["tab\tand\x0bmore", "here"]),
        ("Mixed CASE Words", ["mixed", "case", "words"]),
        ("e.g. one,two /three/", ["e.g", "one,two", "three/"]),
        ("", [""]),
    ],
)
def test_tokenize(one, raw, words):
    assert [w for w in one(text.tokenize, t=raw) if w] == [w for w in words if w]


@settings(
    max_examples=40,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.text(alphabet="abZ .,'\"’{}()-:/\\12“\té\x1c", max_size=40),
        min_size=1,
        max_size=30,
    )
)
def test_tokens_keep_to_the_rules(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", text.tokenize(F.col("t")).alias("w")).collect():
        joined = " ".join(r["w"])
        assert joined == joined.lower()
        assert not set(joined) & set("'’“\"()")
        assert "{" not in joined or "}" not in joined[joined.index("{") :]
        letters = iter(r["t"].lower())
        assert all(c in letters for c in joined if c not in " ")  # in the order of the text


def test_long_runs_stay_linear(one):
    line = "-" * 200_000 + "x " + "{" * 2000
    assert one(text.tokenize, t=line) == line.split(" ")


def tag_docs(spark):
    texts = [
        "b a b a b a c c d d d the the the the",
        " ".join(["k j i h g f e d c b a"] * 3),
        "rare words only",
        "",
        None,
        "quote's it's it's x x x " * 3,
    ]
    return spark.createDataFrame(list(enumerate(texts)), "id int, content string")


@pytest.mark.parametrize("form", ["list", "table"])
def test_top_tags(spark, form):
    words = ["the", "d"]
    if form == "table":
        words = spark.createDataFrame([(w,) for w in [*words, "d", None]], "token string")
    rows = corpus.with_top_tags(tag_docs(spark), words).collect()
    assert {r["id"]: r["automatic"] for r in rows} == {
        0: ["b", "a"],
        1: ["k", "j", "i", "h", "g", "f", "e", "c", "b", "a"],
        2: [],
        3: [],
        4: [],
        5: ["x", "it", "quote"],
    }


def test_top_tags_of_repeated_and_null_keys(spark):
    rows = [("1", "a a a the the the"), ("1", "c c c"), (None, "e e e"), ("1", "a a a the the the")]
    docs = spark.createDataFrame(rows, "id string, content string")
    long = spark.range(30_000).selectExpr("concat('word', id) AS token").union(spark.createDataFrame([("the",)], "token string"))
    for words in (["the"], long):
        got = corpus.with_top_tags(docs, words).collect()
        assert sorted((str(r["id"]), r["automatic"]) for r in got) == [
            ("1", ["a"]), ("1", ["a"]), ("1", ["c"]), ("None", ["e"])
        ]


def test_top_tags_need_no_shuffle(spark):
    plan = corpus.with_top_tags(tag_docs(spark), ["the"])._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_token_counts(spark):
    rows = corpus.token_counts(tag_docs(spark).filter("id = 0")).collect()
    assert {r["token"]: (r["n"], r["first_pos"]) for r in rows} == {
        "b": (3, 0), "a": (3, 1), "c": (2, 6), "d": (3, 8), "the": (4, 11)
    }


def found(one, s):
    return {
        g["name"]: g["values"] for g in one(indicators.extract_indicators, t=s)
    }


@pytest.mark.parametrize(
    "s,name,values",
    [
        ("cve-2024-12345 and CVE-2024-12345", indicators.CVE, ["CVE-2024-12345"]),
        ("T1059.001, TA0001.002 T1059", indicators.ATTACK, ["T1059.001", "TA0001.002"]),
        ("see 1.2.3[.]4 and 10[.]0[.]0[.]1.", indicators.IPV4, ["1.2.3.4", "10.0.0.1"]),
        ("1.2.3.4 5.6.7.8", indicators.IPV4, ["1.2.3.4", "5.6.7.8"]),
        ("1[dot]2(dot)3\\.4", indicators.IPV4, ["1.2.3.4"]),
        ("at fe80::1, 2001:db8:0:0:0:0:0:1 and ::1", indicators.IPV6,
         ["2001:db8:0:0:0:0:0:1", "::1", "fe80::1"]),
        ("x[at]y[.]z or A.b@c.org.", indicators.EMAIL, ["A.b@c.org", "x@y.z"]),
        ("hxxp://a[.]b/c, (https://d.e/f?g=1).", indicators.URL,
         ["http://a.b/c", "https://d.e/f?g=1"]),
        ("hxxps[://]evil[.]com/x", indicators.URL, ["https://evil.com/x"]),
        ("hxxp://evil{.}com/a", indicators.URL, ["http://evil.com/a"]),
        ("ftp[:]//a.b/c", indicators.URL, ["ftp://a.b/c"]),
        ("x{at}y{dot}z", indicators.EMAIL, ["x@y.z"]),
        ("1{.}2{.}3.4", indicators.IPV4, ["1.2.3.4"]),
        ("md5 " + "aB" * 16, indicators.MD5, ["aB" * 16]),
        ("sha1 " + "0f" * 20, indicators.SHA1, ["0f" * 20]),
        ("sha256 " + "0f" * 32, indicators.SHA256, ["0f" * 32]),
        ("sha512 " + "0f" * 64, indicators.SHA512, ["0f" * 64]),
    ],
)
def test_indicator(one, s, name, values):
    assert found(one, s) == {name: values}


@pytest.mark.parametrize(
    "s", ["1.2.3.4.5", "256.1.1.1", "12:30:45", "std::vector", "ab" * 20 + "a", "T1059", ""]
)
def test_no_indicator(one, s):
    assert found(one, s) == {}


def test_registry_is_open(one):
    registry = indicators.default_indicators()
    registry["tickets"] = indicators.pattern_indicator(r"bug#\d+")
    got = one(lambda t: indicators.extract_indicators(t, registry), t="bug#12 bug#12 T1000.001")
    assert [(g["name"], g["values"]) for g in got] == [
        (indicators.ATTACK, ["T1000.001"]), ("tickets", ["bug#12"])
    ]


def test_indicators_long(spark):
    docs = spark.createDataFrame([(1, "1.2.3.4 CVE-2020-0001"), (2, "none")], "id int, content string")
    rows = corpus.indicators_long(docs).collect()
    assert sorted(map(tuple, rows)) == [(1, "CVE's", "CVE-2020-0001"), (1, "ipv4-adresses", "1.2.3.4")]


@pytest.mark.parametrize(
    "raw,utc,naive",
    [
        ("2024-01-02T03:04:05", "2024-01-02 03:04:05", True),
        ("2024-01-02T03:04:05+02:00", "2024-01-02 01:04:05", False),
        ("2024-01-02 03:04:05Z", "2024-01-02 03:04:05", False),
        ("2024-01-02", "2024-01-02 00:00:00", True),
        ("soon", None, False),
        (None, None, False),
    ],
)
def test_assume_utc(one, raw, utc, naive):
    assert one(lambda t: dates.assume_utc(t).cast("string"), t=raw) == utc
    assert one(dates.was_naive, t=raw) is naive


@pytest.mark.parametrize(
    "selected,linked,fall,date,origin",
    [
        ("2024-01-02", "2023-01-01", False, "2024-01-02", "selector"),
        ("Tue, 02 Jan 2024 03:04:05 +0100", None, False, "2024-01-02", "selector"),
        ("March 5, 2021", None, False, "2021-03-05", "selector"),
        ("unreadable", "2023-01-01", False, "2030-01-01", "as_of"),
        ("unreadable", "2023-01-01", True, "2023-01-01", "json_ld"),
        (None, "2023-01-01", False, "2023-01-01", "json_ld"),
        (None, None, False, "2030-01-01", "as_of"),
    ],
)
def test_publish_date(one, selected, linked, fall, date, origin):
    as_of = F.lit("2030-01-01").cast("timestamp")
    got = one(
        lambda s, j: dates.publish_date(s, j, as_of, fall_through=fall), s=selected, j=linked
    )
    assert (str(got["value"])[:10], got["origin"]) == (date, origin)


def test_spread_dates(spark):
    start, end = (F.lit(d).cast("timestamp") for d in ("2024-01-01", "2024-01-02"))
    ids = spark.range(500).select(F.col("id").cast("string").alias("id"))
    drawn = ids.select(dates.spread_dates(F.col("id"), start, end, 7).alias("d"))
    low, high, n = drawn.agg(F.min("d"), F.max("d"), F.count_distinct("d")).first()
    assert str(low) >= "2024-01-01" and str(high) < "2024-01-02" and n > 400
    assert drawn.collect() == drawn.collect()


def test_counts_of_repeated_keys(spark):
    rows = [(1, "a b a"), (1, "b a c"), (None, "x x"), (None, "y x"), (2, "a  b"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "id long, content string").repartition(2)
    got = {tuple(r) for r in corpus.token_counts(docs).collect()}
    assert got == {
        (1, "a", 3, 0), (1, "b", 2, 0), (1, "c", 1, 2), (None, "x", 3, 0), (None, "y", 1, 0),
        (2, "a", 1, 0), (2, "b", 1, 1), (4, "", 1, 0),
    }


def test_words_of_single_rows_stay(spark):
    docs = spark.createDataFrame([(i, "some words some") for i in range(20)], "id long, content string")
    counts = corpus.token_counts(docs)
    assert counts.count() == 40
    counts.collect()
    plan = counts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "isFinalPlan=true" in plan and "Exchange hashpartitioning" not in plan


def test_queries_keep_batches_small(spark, sf):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as registry

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        registry.queries()["top_tags_word_table"](spark, sf)
        assert int(spark.conf.get(key)) <= 500
    finally:
        spark.conf.set(key, before)


def test_texts_without_rare_marks_skip_steps_without_effect(spark):
    raw = ["", "a, b -- 5 c.", "it's a", "x ’s y", "{a} b {c", "“q” (r)", 'say "a, b"', "a 7 8 b\x1fc", "é : ﬁ", "( 5 )", None]
    rows = spark.createDataFrame([(t,) for t in raw], "t string")
    whole = F.split(text._spaced_words(F.col("t"), r"\s", r"\S"), " ")
    for r in rows.select("t", text.tokenize(F.col("t")).alias("w"), whole.alias("all")).collect():
        assert r["w"] == r["all"] or "\x1f" in r["t"]
    plain = F.col("t").rlike("^[^'’{“\"()\x1c-\x1f]*$")
    few = text._spaced_words(F.col("t"), r"\s")
    got = rows.filter(plain).select(few.alias("a"), F.array_join(whole, " ").alias("b")).collect()
    assert len(got) == 3 and all(r["a"] == r["b"] for r in got)
