import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from articlelake.functions import html, selectors, tree
from articlelake.operators import pages
from articlelake.plans.build import build_articles
from articlelake.plans.gather import gather_urls
from articlelake.schemas import PROFILE_SCHEMA

def as_of():
    return F.lit("2030-01-01").cast("timestamp")



def profile(name="p", **over):
    sel = lambda e, f=None: {"element": e, "content_field": f}
    base = {
        "address": "https://a.b/", "method": "scraping", "list": "nav", "boxes": "li",
        "links": "a", "title": sel("h1"), "description": sel('meta[name="description"]', "content"),
        "image_url": sel('meta[property="og:image"]', "content"), "author": sel(".by"),
        "publish_date": sel("time", "datetime"), "container": "article", "remove": [],
    }
    p = {**base, **over}
    return {
        "source": {
            "profile_name": name, "name": name.upper(), "address": p["address"],
            "retrieval_method": p["method"], "news_paths": [],
            "scraping_targets": {
                "container_list": p["list"], "link_containers": p["boxes"], "links": p["links"]
            },
        },
        "scraping": {
            "js_injections": [],
            "meta": {k: p[k] for k in ("title", "description", "image_url", "author", "publish_date")},
            "content": {"container": p["container"], "remove": p["remove"]},
        },
        "enabled": True,
    }


def rules(spark, *profiles):
    return spark.createDataFrame(list(profiles), PROFILE_SCHEMA)


def page_table(spark, *htmls, name="p"):
    rows = [(i, f"https://a.b/{i}", h, name) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, profile string")


def selector(e, f=None):
    return {"element": e, "content_field": f}


@pytest.mark.parametrize(
    "raw,text",
    [
        ("a &amp;lt; b", "a &lt; b"),
        ("&lt;&gt;&quot;&#39;&apos;&amp;", "<>\"''&"),
        ("&copy; &hellip; &#233; &#x1F600; &nosuch; &amp;copy;", "© … é 😀 &nosuch; &copy;"),
        ("&#0; &#xD800; AT&T & co", "� � AT&T & co"),
    ],
)
def test_decode_entities(one, raw, text):
    assert one(html.decode_entities, t=raw) == text


@pytest.mark.parametrize(
    "raw,text",
    [
        ("&#00000065;", "A"),
        ("&#x0000000041;", "A"),
        ("it&#146;s &#150; &#x80;", "it\u2019s \u2013 \u20ac"),
        ("&#" + "9" * 40 + ";", "\ufffd"),
        ("&#x110000; &#xD800;", "\ufffd \ufffd"),
    ],
)
def test_numeric_references(one, raw, text):
    assert one(html.decode_entities, t=raw) == text


@pytest.mark.parametrize(
    "tag,name,value",
    [
        ('<a href="/x?a=1&amp;b" id=q>', "href", "/x?a=1&amp;b"),
        ("<a title='href=\"no\"' HREF='/y'>", "href", "/y"),
        ("<a href=/z>t</a>", "href", "/z"),
        ("<a data-href='/n'>", "href", None),
        ("<input disabled>", "disabled", ""),
    ],
)
def test_attribute(one, tag, name, value):
    assert one(lambda t: html.raw_attribute(t, F.lit(name)), t=tag) == value


def test_blocks_and_markdown(one):
    def texts(source):
        return [b["text"] for b in one(html.text_blocks, t=source)]

    assert texts("<p><b>a<br><p>c") == ["a", "c"]
    assert texts("<div>x<p>y</p>z</div>") == ["x", "y", "z"]

    def markdown(source, table=None):
        return one(lambda t: html.blocks_markdown(html.text_blocks(t), table), t=source)

    assert markdown("<h2>x</h2><li>y</li>") == "## x\n\n- y"
    assert markdown('<p>see <a title="t" href="/u">here</a> <b>now</b> <em>a</em></p>') == (
        "see [here](/u) **now** *a*"
    )
    assert markdown("<pre>a\n  b</pre>") == "```\na\n  b\n```"
    table = html.default_converters()
    table["h2"] = lambda t: F.upper(t)
    assert markdown("<h2>x</h2>", table) == "X"


def test_inline_converters(one):
    def markdown(source, table):
        return one(lambda t: html.blocks_markdown(html.text_blocks(t), None, table), t=source)

    page = '<p>see <a title="t" href="/u?a=1&amp;b">the <b> bold </b> one</a>, <a>none</a> &amp; <em>more</em> <code>x</code></p>'
    assert markdown(page, html.default_inline()) == "see [the **bold** one](/u?a=1&b), none & *more* `x`"
    table = html.default_inline()
    table["a"] = lambda text, tag: F.upper(text)
    del table["em"]
    assert markdown(page, table) == "see THE **BOLD** ONE, NONE & more `x`"
    assert markdown("<p>plain</p><p><b>open", table) == "plain\n\nopen"


@pytest.mark.parametrize(
    "css,steps",
    [
        ("div.ad", [1]), ("#main", [1]), ('meta[property="og:title"]', [1]), ("a.b.c", [1]), ("[a='x, y > z']", [1]),
        ("body > p", [2]), ("ul li>a", [3]), ("h1, h2 b", [1, 2]), ("p:first-child", None), ("> p", None), ("a,,b", None),
    ],
)
def test_compile_rule(one, css, steps):
    rule = one(selectors.compile_rule, css=css)
    assert (rule["open"] is not None) is (steps == [1])
    assert (rule["paths"] and [len(p) for p in rule["paths"]]) == steps
    assert (rule["error"] is None) is (steps is not None)


def test_no_rule(one):
    assert one(selectors.compile_rule, css=" ") is None


@pytest.mark.parametrize(
    "css,tag,hit",
    [
        ("a.x", '<a class="y x">', True), ("a.x", '<a class="yx">', False), ("a.x", "<a title='class=x'>", False),
        ("[href^='/p']", "<a href=/p/q>", True), ("[href$=q]", '<a href="/p/q">', True), ("[href*='.+']", '<a href="a.b">', False),
        ("A#Q", "<a id=Q>", True), ("*[data-x]", "<b data-x>", True), ("b", "<br>", False), ("a[rel~=no]", '<a rel="yes no">', True),
    ],
)
def test_open_patterns(one, css, tag, hit):
    found = one(lambda c, t: selectors.first_open(t, selectors.compile_rule(c)), c=css, t=tag)
    assert (found == tag) is hit


def elements(one, page):
    found = one(tree.page_tree, t=page)
    return [("".join(found["pieces"][e["at"] : e["until"] + 1]), e["level"]) for e in found["elements"]]


def test_tree(one):
    assert elements(one, "x<div>a<div>b</div><br>c</div>y") == [("<div>a<div>b</div><br>c</div>", 1), ("<div>b</div>", 2), ("<br>", 2)]
    # Unclosed elements reach to the end of what is around them; stray close tags are passed over.
    assert elements(one, "</p><ul><li>a<li>b</ul>c<p>d") == [
        ("<ul><li>a<li>b</ul>", 1), ("<li>a<li>b", 2), ("<li>b", 3), ("<p>d", 1)
    ]
    assert elements(one, "<b><i>x</b></i>") [0] == ("<b><i>x</b>", 1)
    assert elements(one, "") == [] and elements(one, "a < b") == []


def found_in(spark, page, css, *remove):
    row = spark.createDataFrame([(page, css, list(remove))], "t string, c string, r array<string>")
    row = row.select(tree.page_tree(F.col("t")).alias("t"), selectors.compile_rule(F.col("c")).alias("c"), F.transform(F.col("r"), selectors.compile_rule).alias("r"))
    row = row.select("t", tree.matches(F.col("t"), F.col("c.paths")).alias("f"), selectors.removed_elements(F.col("t"), F.col("r")).alias("h"))
    return row.select(selectors.outer_without(F.col("t"), F.col("f"), F.col("h")).alias("v")).first()["v"]


def test_paths(spark):
    page = "<div><p>1</p><div><p>2</p></div></div><p>3</p><section><b><p>4</p></b></section>"
    assert found_in(spark, page, "div > p") == ["<p>1</p>", "<p>2</p>"]
    assert found_in(spark, page, "div div p") == ["<p>2</p>"]
    assert found_in(spark, page, "section > p") == []
    assert found_in(spark, "<html><body><nav>x</nav><br><p>y", "body > nav, body > p") == ["<nav>x</nav>", "<p>y"]
    assert found_in(spark, page, "section p, div > p, p") == ["<p>1</p>", "<p>2</p>", "<p>3</p>", "<p>4</p>"]
    assert found_in(spark, "<div><div><div>x</div></div></div>", "div > div > div") == ["<div>x</div>"]
    holes = "<div>a<i>b<i>c</i></i>d<b>e</b></div><i><div>f</div></i>"
    assert found_in(spark, holes, "div", "i", "b", "i i") == ["<div>ad</div>"]


@pytest.mark.parametrize("before,tag,after", [("", "<div>", ""), ("<div class=c>", "<p>", "</div>"), ("<b>", "</div>", "<i>")])
def test_many_tags_stay_linear(one, before, tag, after):
    page = before + tag * 100_000 + after
    found = one(lambda t: F.size(tree.page_tree(t)["elements"]), t=page)
    assert found == page.replace("</", "").count("<")


def test_unsupported_selectors_are_rejected(spark):
    page = f"<body>{HEAD}<h1>T</h1><article>x</article>{NAV}</body>"
    table = page_table(spark, page)
    bad = rules(spark, profile(container="article:first-child", boxes="li:hover"))
    made, rejected = build_articles(table, bad, ["the"], as_of())
    assert made.isEmpty() and rejected.first()["errors"] == ["unsupported selector: article:first-child"]
    found, failed = pages.extract_links(table, bad)
    assert found.isEmpty() and failed.first()["reason"] == "unsupported selector: li:hover"


def test_nested_rules_use_no_python(spark):
    p = rules(spark, profile(container="body > article", remove=["article div.ad"], boxes="ul > li", title=selector("body h1")))
    for frame in (pages.extract_content(page_table(spark, "x"), p), pages.page_links(page_table(spark, "x"), p)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "InArrow" not in plan and "InPandas" not in plan


def links(spark, page, n=10, **over):
    p = rules(spark, profile(**over))
    found, failed = pages.extract_links(page_table(spark, *page), p, n)
    return sorted(r["url"] for r in found.collect()), failed.count()


NAV = '<nav><ul><li><a name="x">no</a></li><li><a href="/b?x=1&amp;y">b</a></li><li><a href="https://o.p/c">c</a></li></ul></nav><li><a href="/out">o</a></li>'


@pytest.mark.parametrize("lists,boxes", [("nav", "li"), ("body nav", "ul > li"), ("nav", "nav li")])
def test_links(spark, lists, boxes):
    page = [f"<body>{NAV}</body>"]
    assert links(spark, page, list=lists, boxes=boxes) == (["https://a.b/b?x=1&y", "https://o.p/c"], 0)
    # The cap counts the link that has no address.
    assert links(spark, page, 2, list=lists, boxes=boxes) == (["https://a.b/b?x=1&y"], 0)


def test_links_whole_page_and_missing_list(spark):
    page = [f"<body>{NAV}</body>", "<body>no list</body>"]
    assert links(spark, page, list=None)[0] == ["https://a.b/b?x=1&y", "https://a.b/out", "https://o.p/c"]
    assert links(spark, page) == ([], 1)
    assert links(spark, page[:1], boxes="a", links=None)[0] == ["https://a.b/b?x=1&y", "https://o.p/c"]


def test_nested_boxes(spark):
    page = ['<nav><div class="r"><div>x</div><a href="/1">1</a></div><div class="r"><a href="/2">2</a></div></nav>']
    assert links(spark, page, boxes="div.r")[0] == ["https://a.b/1", "https://a.b/2"]


HEAD = (
    '<meta name="description" content="d &amp; e"><meta content="/i.png" property="og:image">'
    '<time datetime="2024-02-03T04:05:06">x</time><span class="x by y"> Ann </span>'
)


def meta(spark, page, **over):
    return pages.extract_meta(page_table(spark, page), rules(spark, profile(**over)), as_of()).first()


def test_meta(spark):
    m = meta(spark, f"<script>'<h1>no</h1>'</script>{HEAD}<h1>T <i>1</i></h1><h1>other</h1>")
    assert (m["title"], m["description"], m["image_url"], m["author"]) == ("T 1", "d & e", "/i.png", "Ann")
    assert str(m["publish_date"]) == "2024-02-03 04:05:06" and m["date_origin"] == "selector"
    assert m["errors"] == []


def test_meta_defaults_and_rejects(spark):
    m = meta(spark, "<h2>no title</h2>")
    assert m["errors"] == ["title not found", "description not found"]
    assert m["image_url"] == "https://a.b/favicon.ico" and m["author"] is None
    assert m["date_origin"] == "as_of"


def test_meta_with_parents(spark):
    page = f"<div><h1>menu</h1></div><main>{HEAD}<h1>real<h1>deep</h1></h1></main>"
    m = meta(spark, page, title=selector("main > h1"))
    assert m["title"] == "realdeep"
    nested = meta(spark, f"{HEAD}<div class='t'>a<div>b</div>c</div>", title=selector("div.t"))
    assert nested["title"] == "abc"


def test_json_ld(spark):
    ld = (
        '<script type="application/ld+json">{bad</script>'
        '<script type="application/ld+json">{"author": {"@type": "Person", "url": "u",'
        ' "name": "Zoë \\"Z\\" "}, "datePublished": "2023-05-06"}</script>'
    )
    m = meta(spark, f"<h1>t</h1>{ld}{HEAD}", author=selector(None), publish_date=selector(None))
    assert m["author"] == 'Zoë "Z"' and str(m["publish_date"]) == "2023-05-06 00:00:00"
    kept = meta(spark, f"<h1>t</h1>{ld}{HEAD}".replace("2024-02-03T04:05:06", "soon"))
    assert kept["date_origin"] == "as_of"


CONTENT = (
    "<style>p{}</style><article><h1>H</h1><script>x('</article>')</script><p> a </p>"
    '<div class="ad">buy<div>now</div></div><p>b</article><article>two</article>'
)


def content(spark, page, **over):
    p = rules(spark, profile(**over))
    return pages.extract_content(page_table(spark, page), p).first()


@pytest.mark.parametrize("container", ["article", "body > article", "body article"])
def test_content(spark, container):
    c = content(spark, f"<body>{CONTENT}</body>", container=container, remove=["div.ad"])
    assert c["content_text"] == "H\na\nb\ntwo\n"
    assert "<script" not in c["content_html"] and "buy" not in c["content_html"]


def test_content_without_match(spark):
    c = content(spark, "<p>x</p>")
    assert (c["content_text"], c["content_html"]) == ("", "")


def test_nested_container(spark):
    page = '<div class="c">a<div>b</div>c</div><div>d</div>'
    assert content(spark, page, container="div.c")["content_text"] == "a\nb\nc\n"


def test_unclosed_container(spark):
    assert content(spark, "<article><p>a<p>b", container="article")["content_text"] == "a\nb\n"


def test_build_articles(spark):
    good = f"<body>{HEAD}<h1>T</h1><article><p>spam spam spam 1.2.3.4</p></article></body>"
    table = page_table(spark, good, "<p>bad</p>", good)
    stored = spark.createDataFrame([Row(url="https://a.b/2")])
    made, rejected = build_articles(table, rules(spark, profile()), ["the"], as_of(), stored)
    (a,) = made.collect()
    assert (a["url"], a["profile"], a["source"], a["content"]) == (
        "https://a.b/0", "p", "P", "spam spam spam 1.2.3.4 "
    )
    assert a["tags"]["automatic"] == ["spam"]
    assert [(t["name"], t["values"]) for t in a["tags"]["interesting"]] == [("ipv4-adresses", ["1.2.3.4"])]
    assert a["ml"]["labels"] == [] and a["ml"]["incident"] == 0
    assert [r["url"] for r in rejected.collect()] == ["https://a.b/1"]


def test_gather_urls(spark):
    profiles = rules(
        spark,
        profile("feed", method="rss"), profile("page"), profile("odd", method="mail"),
        profile("badfeed", method="rss"), profile("nolist", method="dynamic"),
    )
    rss = "<rss><channel><item><guid>1</guid></item><item><guid>1</guid></item><item><guid>3</guid></item></channel></rss>"
    feeds = spark.createDataFrame(
        [("feed", "f1", rss), ("badfeed", "f2", rss), ("badfeed", "f3", "<html>"), ("page", "f4", rss)],
        "profile string, feed_url string, xml string",
    )
    fronts = spark.createDataFrame(
        [("page", "u", f"<body>{NAV}</body>"), ("nolist", "u", "<p>x")],
        "profile string, url string, html string",
    )
    found, failed = gather_urls(profiles, feeds, fronts, 2)
    assert sorted(map(tuple, found.collect())) == [
        ("feed", "1"), ("feed", "1"), ("page", "https://a.b/b?x=1&y")
    ]
    assert {r["profile"] for r in failed.collect()} == {"odd", "badfeed", "nolist"}
    _, failed = gather_urls(profiles, feeds.limit(0), fronts.limit(0), 2)
    assert {(r["profile"], r["reason"]) for r in failed.collect()} >= {("feed", "no feed"), ("page", "no front page")}


def test_every_page_is_an_article_or_a_reject(spark):
    good = f"<body>{HEAD}<h1>T</h1><article><p>x</p></article></body>"
    table = page_table(spark, good, good, "<p>bad", good).withColumn(
        "status", F.when(F.col("url").endswith("1"), 404).otherwise(200)
    ).withColumn("profile", F.when(F.col("url").endswith("3"), "unheard of").otherwise(F.col("profile")))
    made, rejected = build_articles(table, rules(spark, profile()), ["the"], as_of())
    reasons = {r["url"][-1]: list(r["errors"]) for r in rejected.collect()}
    assert made.count() + len(reasons) == 4
    assert reasons["1"] == ["status 404"] and reasons["3"] == ["no profile"] and "2" in reasons


@pytest.mark.parametrize("blank", [" ", "\u00a0"])
def test_trims_stay_linear(one, blank):
    text = "a" + blank * 300_000 + "b" + blank * 300_000
    assert one(html._trim, t=text) == text.rstrip()


def test_parsing_moves_no_page(spark, sf):
    """Between the rule join and the finished article nothing is shuffled."""
    table = spark.read.parquet(f"{sf}/pages.parquet").withColumn("profile", F.lit("p"))
    made, _ = build_articles(table, rules(spark, profile()), ["the"], as_of())
    plan = made._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("profile" in line for line in shuffled) and "SortMergeJoin" not in plan


def test_status(spark):
    table = spark.createDataFrame([(1, 200), (2, 404), (3, None)], "page_id int, status int")
    good, bad = pages.split_by_status(table)
    assert [r["page_id"] for r in good.collect()] == [1]
    assert sorted((r["page_id"], r["reason"]) for r in bad.collect()) == [(2, "status 404"), (3, "status missing")]
