"""Registered queries, each with the same computation in ANSI SQL.

Every query reads whole tables. Values the tables lack (indicators, dates,
feeds, headers) are derived from them by plain expressions that both sides
write out the same way.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.functions import dates, html, indicators, models, text, urls
from articlelake.operators import corpus, labels, merge, pages, quality
from articlelake.plans import build, gather
from articlelake.plans import corpus as jobs
from articlelake.schemas import ARTICLE_SCHEMA, COPIED_FIELDS
from articlelake.session import scratch_dir, small_batches, spread
from articlelake.sources import readers, writers
from articlelake.sources.buckets import BucketStore
from articlelake.sources.store import ArticleStore
from articlelake.streaming.ingest import ingest_incremental

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(function):
        _QUERIES[function.__name__] = function
        if sql is not None:
            _ORACLES[function.__name__] = sql
        return function

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _llm("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _ORACLES | _llm("ORACLES")


def _llm(part: str) -> dict:
    """Queries over text corpora, where that subpackage is there."""
    try:
        from articlelake.llm import queries as llm
    except ImportError as e:
        # Only its absence is passed over, not a fault in it or a library it lacks.
        if e.name not in ("articlelake.llm", "articlelake.llm.queries", "corpus_pipeline"):
            raise
        return {}
    return getattr(llm, part)


def entry(spark: SparkSession) -> DataFrame:
    """Keyword tags and number of indicator groups of every document."""
    docs = _cleaned(spark, "/root/testdata/sf0.001")
    tagged = corpus.with_tags(docs, COMMON, text="content", key="doc_id")
    return tagged.select(
        "doc_id",
        F.col("tags.automatic").alias("tags"),
        F.size("tags.interesting").alias("indicator_groups"),
    )


# ------------------------------------------------------------------ shared inputs

COMMON = ["the", "of", "and", "la", "de", "der", "die", "que", "le"]
AS_OF = "2024-06-01 00:00:00"
START, END = "2024-01-01 00:00:00", "2024-03-01 00:00:00"
SPAN = 60 * 24 * 60 * 60


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    small_batches(spark)
    table = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(table) if name in ("documents", "pages") else table


def _ts(value: str) -> Column:
    return F.lit(value).cast("timestamp")


def _stamp(column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return docs.select("doc_id", text.clean_text(F.col("text")).alias("content"))


def _nfkd_sql(value: str) -> str:
    """Compatibility form of the Latin letters, spelled as nested replaces."""
    for code in range(0xA0, 0x180):
        char = chr(code)
        flat = unicodedata.normalize("NFKD", char)
        if flat != char:
            value = f"replace({value}, '{char}', '{flat}')"
    return value


_DASH_SQL = "'" + text.DASHES + "'"


def _clean_sql(value: str) -> str:
    flat = f"replace({_nfkd_sql(value)}, chr(10), ' ')"
    return f"translate({flat}, {_DASH_SQL}, '{'-' * len(text.DASHES)}')"


def _tokens_sql(value: str) -> str:
    marks = r"""[,."''/\\:-]+"""
    for pattern, by in (
        (r"""[''’]\S*""", ""),
        (rf"\s{marks}|{marks}\s", " "),
        (r"\{.*\}", ""),
        ("[“\"()]", " "),
        (r"\s[^a-zA-Z]*\s", " "),
    ):
        value = f"regexp_replace({value}, '{pattern}', '{by}', 'g')"
    return f"string_split(lower({value}), ' ')"


_COMMON_SQL = ", ".join(f"'{w}'" for w in COMMON)

# Spark derives the same columns in `_articles`.
_ART_URL = "'https://' || source || '.example.org/a/' || doc_id"


def _draw_sql(key: str, seed: int, span: int) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 15))::BIGINT % {span})"


_ARTICLES_SQL = f"""
articles AS (
  SELECT doc_id, md5({_ART_URL}) AS id, {_ART_URL} AS url,
         'Document ' || doc_id AS title, lang || ' text of ' || source AS description,
         source AS profile, upper(source) AS source, text AS content, n_chars,
         TIMESTAMP '{START}' + to_seconds({_draw_sql("md5(" + _ART_URL + ")", 1, SPAN)}) AS publish_date
  FROM documents)"""


def _articles(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    url = F.concat(F.lit("https://"), "source", F.lit(".example.org/a/"), "doc_id")
    return docs.select(
        "doc_id",
        urls.article_id(url).alias("id"),
        url.alias("url"),
        F.concat(F.lit("Document "), "doc_id").alias("title"),
        F.concat("lang", F.lit(" text of "), "source").alias("description"),
        F.col("source").alias("profile"),
        F.upper("source").alias("source"),
        F.col("text").alias("content"),
        "n_chars",
    ).withColumn(
        "publish_date", dates.spread_dates(F.col("id"), _ts(START), _ts(END), 1)
    )


# `ml` of an article: labelled when the label table knows the document.
_ML_SQL = f"""{_ARTICLES_SQL},
judged AS (
  SELECT a.*, CASE WHEN l.quality = 1 THEN 'research' END AS label,
         CASE WHEN l.doc_id IS NULL THEN 0 ELSE l.toxic + 1 END AS incident
  FROM articles a LEFT JOIN labels l USING (doc_id))"""


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    marks = _table(spark, sf, "labels")
    joined = _articles(spark, sf).join(marks, "doc_id", "left")
    names = F.when(F.col("quality") == 1, F.array(F.lit("research"))).otherwise(
        F.array().cast("array<string>")
    )
    incident = F.when(F.col("toxic").isNull(), F.lit(0)).otherwise(F.col("toxic") + 1)
    ml = F.struct(names.alias("labels"), incident.cast("int").alias("incident"))
    return joined.withColumn("ml", ml).drop("quality", "toxic")


_HOST_SQL = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"


def _selector(element: str | None, field: str | None = None) -> Column:
    return F.struct(
        F.lit(element).cast("string").alias("element"),
        F.lit(field).cast("string").alias("content_field"),
    )


def _profiles(
    spark: SparkSession,
    sf: str,
    container: str = "article",
    remove: tuple[str, ...] = ("div.ad",),
    lists: str | None = "nav",
    boxes: str = "li",
    method: Column | None = None,
) -> DataFrame:
    """One profile per host of the pages table."""
    hosts = (
        _table(spark, sf, "pages")
        .select(urls.url_host(F.col("url")).alias("host"))
        .distinct()
    )
    removed = F.array(*[F.lit(r) for r in remove]) if remove else F.array()
    return hosts.select(
        F.struct(
            F.col("host").alias("profile_name"),
            F.upper("host").alias("name"),
            F.concat(F.lit("http://"), "host", F.lit("/")).alias("address"),
            (F.lit("scraping") if method is None else method).alias("retrieval_method"),
            F.array(F.concat(F.lit("http://"), "host", F.lit("/"))).alias("news_paths"),
            F.struct(
                F.lit(lists).cast("string").alias("container_list"),
                F.lit(boxes).alias("link_containers"),
                F.lit("a").alias("links"),
            ).alias("scraping_targets"),
        ).alias("source"),
        F.struct(
            F.array(F.lit("consent"), F.concat(F.lit("more-"), F.length("host"))).alias(
                "js_injections"
            ),
            F.struct(
                _selector("title").alias("title"),
                _selector("h1").alias("description"),
                _selector("img", "src").alias("image_url"),
                _selector(None).alias("author"),
                _selector(None).alias("publish_date"),
            ).alias("meta"),
            F.struct(
                F.lit(container).alias("container"),
                removed.cast("array<string>").alias("remove"),
            ).alias("content"),
        ).alias("scraping"),
        F.lit(True).alias("enabled"),
    )


def _pages(spark: SparkSession, sf: str, profiles: DataFrame) -> DataFrame:
    return pages.with_profile(_table(spark, sf, "pages"), profiles)


_NOISE_SQL = (
    r"(?is)<!--.*?-->|<script[\s>/].*?</script\s*>|<style[\s>/].*?</style\s*>"
)
_CLEAN_PAGE_SQL = f"regexp_replace(html, '{_NOISE_SQL}', '', 'g')"
_TAG_SQL = "<[^>]*>"


def _decode_sql(value: str) -> str:
    for name, char in (
        ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "''"), ("#39", "''"), ("amp", "&"),
    ):
        value = f"replace({value}, '&{name};', '{char}')"
    return value


def _trim_sql(value: str) -> str:
    return rf"regexp_replace({value}, '^\s+|\s+$', '', 'g')"


_EDGE_SQL = "(?i)<(/?)(" + "|".join(html.BLOCK_TAGS) + r")(?:[\s/][^>]*)?>"

# Text blocks of the content element: (page_id, url, pos, tag, body, text).
_BLOCKS_SQL = rf"""
content AS (
  SELECT page_id, url, regexp_replace({_CLEAN_PAGE_SQL},
           '(?is)<div class="ad">.*?</div>', '', 'g') AS page FROM pages),
found AS (
  SELECT page_id, url, unnest(string_split(regexp_replace(
           regexp_extract(page, '(?is)<article[^>]*>.*?</article\s*>'),
           '{_EDGE_SQL}', chr(1) || '\1\2' || chr(2), 'g'), chr(1))) AS piece,
         generate_subscripts(string_split(regexp_replace(
           regexp_extract(page, '(?is)<article[^>]*>.*?</article\s*>'),
           '{_EDGE_SQL}', chr(1) || '\1\2' || chr(2), 'g'), chr(1)), 1) AS nth
  FROM content),
cut AS (
  SELECT page_id, url, nth,
         CASE WHEN contains(piece, chr(2)) AND piece NOT LIKE '/%'
              THEN lower(split_part(piece, chr(2), 1)) ELSE '' END AS tag,
         CASE WHEN contains(piece, chr(2)) THEN split_part(piece, chr(2), 2)
              ELSE piece END AS body FROM found),
blocks AS (
  SELECT page_id, url, row_number() OVER (PARTITION BY page_id ORDER BY nth) - 1 AS pos,
         tag, body, text
  FROM (SELECT *, {_trim_sql(_decode_sql(
      "regexp_replace(regexp_replace(body, '(?i)<br[^>]*>', chr(10), 'g'), '" + _TAG_SQL + "', '', 'g')"))} AS text
        FROM cut)
  WHERE text <> '')"""


# ------------------------------------------------------------------- text analytics


@_query(f"SELECT doc_id, {_clean_sql('text')} AS content FROM documents")
def clean_text(spark, sf):
    return _cleaned(spark, sf)


_TOKENS_CTE = f"""
words AS (SELECT doc_id, {_tokens_sql(_clean_sql('text'))} AS toks FROM documents),
placed AS (SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) - 1 AS pos FROM words)"""

_TAGS_CTE = f"""{_TOKENS_CTE},
counted AS (SELECT doc_id, token, count(*) AS n, min(pos) AS seen FROM placed
            WHERE token <> '' GROUP BY ALL HAVING count(*) >= 3)"""


@_query(
    f"WITH {_TOKENS_CTE} SELECT doc_id, token, count(*) AS n, min(pos)::BIGINT AS first_pos "
    "FROM placed GROUP BY doc_id, token"
)
def tokenize_counts(spark, sf):
    counts = corpus.token_counts(_cleaned(spark, sf), "doc_id", "content")
    return counts.withColumn("first_pos", F.col("first_pos").cast("bigint"))


def _ranked(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.posexplode_outer("automatic").alias("rank", "token")
    ).filter("token is not null").withColumn("rank", (F.col("rank") + 1).cast("bigint"))


@_query(f"""WITH {_TAGS_CTE}
SELECT doc_id, rank, token FROM (
  SELECT doc_id, token, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, seen) AS rank
  FROM counted WHERE token NOT IN ({_COMMON_SQL})) WHERE rank <= 10""")
def top_tags(spark, sf):
    return _ranked(
        corpus.with_top_tags(_cleaned(spark, sf), COMMON, key="doc_id")
    )


@_query(f"""WITH {_TAGS_CTE},
common AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS token FROM benchmark)
SELECT doc_id, rank, token FROM (
  SELECT doc_id, token, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, seen) AS rank
  FROM counted WHERE token NOT IN (SELECT token FROM common)) WHERE rank <= 10""")
def top_tags_word_table(spark, sf):
    """The common words are those of the benchmark passages."""
    words = _table(spark, sf, "benchmark").select(
        F.explode(F.split(F.lower("text"), " ")).alias("token")
    )
    return _ranked(corpus.with_top_tags(_cleaned(spark, sf), words, key="doc_id"))


# Each document also mentions indicators made from its own id.
_SEEDED_SQL = """
seeded AS (
  SELECT doc_id, text || ' cve-' || (2020 + doc_id % 5) || '-' || (1000 + doc_id % 50) ||
    ' T' || (1000 + doc_id % 9) || '.00' || (doc_id % 9) ||
    ' at 10[.]0.' || (doc_id % 256) || '[.]7, by a' || doc_id || '[at]mail[.]example ' ||
    'hxxp://bad' || doc_id || '[.]example/x?y=1. ' || md5(doc_id::VARCHAR) || ' ' ||
    sha256(doc_id::VARCHAR) || ' (2001:db8::' || (doc_id % 10) || ') ' || doc_id || '.1.2.3.4' AS text
  FROM documents)"""


def _seeded(spark: SparkSession, sf: str) -> DataFrame:
    def n(mod: int, plus: int = 0) -> Column:
        return (F.col("doc_id") % mod + plus).cast("string")

    key = F.col("doc_id").cast("string")
    parts = [
        F.col("text"), " cve-", n(5, 2020), "-", n(50, 1000), " T", n(9, 1000), ".00", n(9),
        " at 10[.]0.", n(256), "[.]7, by a", key, "[at]mail[.]example hxxp://bad", key,
        "[.]example/x?y=1. ", F.md5(key), " ", F.sha2(key, 256), " (2001:db8::", n(10), ") ",
        key, ".1.2.3.4",
    ]
    seeded = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return _table(spark, sf, "documents").select("doc_id", seeded.alias("content"))


_DOT_SQL = r"(?:[\[(\\]{0,2}\.[\])]{0,2}|\[dot\]|\(dot\))"
_AT_SQL = r"(?:@|\[@\]|\(@\)|\[at\]|\(at\))"
_OCT_SQL = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _each(pattern: str) -> str:
    return f"SELECT doc_id, unnest(regexp_extract_all(text, '{pattern}')) AS v FROM seeded"


def _undot(value: str) -> str:
    return f"regexp_replace({value}, '{_DOT_SQL}', '.', 'g')"


def _hash_sql(n: int) -> str:
    return f"SELECT doc_id, v FROM ({_each('[0-9A-Fa-f]{32,}')}) WHERE length(v) = {n}"


_INDICATOR_SQL = {
    "CVE''s": f"SELECT doc_id, upper(v) AS v FROM ({_each(indicators.CVE_PATTERN)})",
    "MITRE IDs": f"SELECT doc_id, upper(v) AS v FROM ({_each(indicators.ATTACK_PATTERN)})",
    "ipv4-adresses": f"SELECT doc_id, v FROM (SELECT doc_id, {_undot('v')} AS v FROM "
    f"({_each('[0-9]+(?:' + _DOT_SQL + '[0-9]+)*')})) "
    rf"WHERE regexp_full_match(v, '(?:{_OCT_SQL}\.){{3}}{_OCT_SQL}')",
    "ipv6-adresses": f"SELECT doc_id, v FROM ({_each('[0-9A-Za-z_]*:[0-9A-Za-z_:]*')}) WHERE "
    "regexp_full_match(v, '(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}') OR (regexp_full_match(v, "
    "'(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?') "
    "AND len(regexp_extract_all(v, '[0-9A-Fa-f]+')) BETWEEN 1 AND 7)",
    "email-adresses": f"SELECT doc_id, regexp_replace({_undot('v')}, '{_AT_SQL}', '@') AS v FROM "
    f"({_each('[A-Za-z0-9_.+-]+' + _AT_SQL + '[A-Za-z0-9-]+(?:' + _DOT_SQL + '[A-Za-z0-9-]+)+')})",
    "urls": rf"SELECT doc_id, regexp_replace(regexp_replace({_undot('v')}, '^(?i)h(?:xx|tt)(ps?)\[?:\]?//', "
    r"'htt\1://'), '[.,;:!?)\]]+$', '') AS v FROM "
    f"({_each(chr(40) + '?i' + chr(41) + 'h(?:tt|xx)ps?' + chr(92) + '[?:' + chr(92) + ']?//[^' + chr(92) + 's<>' + chr(34) + chr(39) * 2 + '`{}|^]+')})",
    "MD5-hash": _hash_sql(32),
    "SHA1-hash": _hash_sql(40),
    "SHA256-hash": _hash_sql(64),
    "SHA512-hash": _hash_sql(128),
}

_FOUND_SQL = f"""{_SEEDED_SQL}, found AS (
""" + "\nUNION\n".join(
    f"SELECT doc_id, {i} AS nth, '{name}' AS name, v AS value FROM ({sql})"
    for i, (name, sql) in enumerate(_INDICATOR_SQL.items())
) + ")"


@_query(f"WITH {_FOUND_SQL} SELECT doc_id, name, value FROM found")
def indicators_long(spark, sf):
    return corpus.indicators_long(_seeded(spark, sf), "doc_id")


@_query(f"""WITH {_FOUND_SQL},
grouped AS (SELECT doc_id, nth, name || '=' || string_agg(value, ',' ORDER BY value) AS g
            FROM found GROUP BY doc_id, nth, name)
SELECT doc_id, string_agg(g, ';' ORDER BY nth) AS groups FROM grouped GROUP BY doc_id""")
def indicators_nested(spark, sf):
    found = corpus.with_indicators(_seeded(spark, sf))
    shown = F.transform(
        "interesting",
        lambda g: F.concat(g["name"], F.lit("="), F.array_join(g["values"], ",")),
    )
    return found.select("doc_id", F.array_join(shown, ";").alias("groups"))


@_query(f"""WITH {_TAGS_CTE}, ranked AS (
  SELECT doc_id, token, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, seen) AS rank
  FROM counted WHERE token NOT IN ({_COMMON_SQL}))
SELECT d.doc_id, coalesce(string_agg(token, ' ' ORDER BY rank), '') AS tags
FROM documents d LEFT JOIN ranked r ON d.doc_id = r.doc_id AND rank <= 10 GROUP BY d.doc_id""")
def regenerate_tags(spark, sf):
    """Recompute the tags of stored articles; those without tags keep an empty list."""
    stale = _cleaned(spark, sf).withColumn(
        "tags", F.lit(None).cast(ARTICLE_SCHEMA["tags"].dataType)
    )
    fresh = jobs.regenerate_tags(stale, COMMON)
    return fresh.select("doc_id", F.array_join("tags.automatic", " ").alias("tags"))


# Vectors: title and description as made up above, one chunk per line of text.
_VECTOR_SQL = f"""
parts AS (
  SELECT doc_id, 0::BIGINT AS part, 'Document ' || doc_id AS text FROM documents
  UNION ALL SELECT doc_id, 1, lang || ' text of ' || source FROM documents
  UNION ALL SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) + 1,
                   unnest(string_split(text, chr(10))) FROM documents),
words AS (
  SELECT doc_id, part, unnest({_tokens_sql(_clean_sql('text'))}) AS token FROM parts),
counted AS (
  SELECT doc_id, part, token, count(*) AS n FROM words WHERE token <> '' GROUP BY doc_id, part, token),
df AS (SELECT token, count(*) AS df FROM counted GROUP BY token)
SELECT doc_id, part, token,
       round((n * (ln(((SELECT count(*) FROM parts) + 1) / (df + 1)) + 1))::FLOAT::DOUBLE, 3) AS weight
FROM counted JOIN df USING (token)"""


@_query(f"WITH {_VECTOR_SQL}")
def sparse_embed(spark, sf):
    return _vector_rows(corpus.sparse_embed(_to_embed(spark, sf)))


def _load_length_model() -> Callable:
    """Stands for a model read from files: a word's weight is its count times its length."""

    def weigh(texts):
        counts = [Counter(w for w in t.split(" ") if w) for t in texts]
        return [{w: n * len(w) for w, n in c.items()} for c in counts]

    return weigh


@_query("""WITH parts AS (
  SELECT doc_id, 0::BIGINT AS part, 'Document ' || doc_id AS text FROM documents
  UNION ALL SELECT doc_id, 1, lang || ' text of ' || source FROM documents
  UNION ALL SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) + 1,
                   unnest(string_split(text, chr(10))) FROM documents),
words AS (SELECT doc_id, part, unnest(string_split(text, ' ')) AS token FROM parts)
SELECT doc_id, part, token, (count(*) * length(token))::DOUBLE AS weight FROM words WHERE token <> '' GROUP BY doc_id, part, token""")
def sparse_embed_model(spark, sf):
    """Vectors by a user's model, run over batches; many articles share an id."""
    articles = _to_embed(spark, sf).withColumn("id", F.col("profile"))
    return _vector_rows(corpus.sparse_embed(articles, models.model_weigher(_load_length_model)))


def _to_embed(spark: SparkSession, sf: str) -> DataFrame:
    chunk = "array<struct<text:string,elser:map<string,float>>>"
    lines = F.transform(
        F.split("content", "\n"), lambda t: F.struct(t, F.lit(None))
    ).cast(chunk)
    vector = F.lit(None).cast("struct<elser:map<string,float>>")
    return _articles(spark, sf).withColumn(
        "embeddings",
        F.struct(
            vector.alias("title"), vector.alias("description"), lines.alias("content_chunks")
        ),
    )


def _vector_rows(done: DataFrame) -> DataFrame:
    vectors = F.concat(
        F.array("embeddings.title.elser", "embeddings.description.elser"),
        F.transform("embeddings.content_chunks", lambda c: c["elser"]),
    )
    return (
        done.select("doc_id", F.posexplode_outer(vectors).alias("part", "v"))
        .select("doc_id", "part", F.explode_outer("v").alias("token", "weight"))
        .filter("token is not null")
        .select(
            "doc_id",
            F.col("part").cast("bigint").alias("part"),
            "token",
            F.round(F.col("weight").cast("double"), 3).alias("weight"),
        )
    )


# --------------------------------------------------------------------------- pages

_LINKS_SQL = rf"""
boxes AS (
  SELECT page_id, url, unnest(regexp_extract_all(regexp_extract({_CLEAN_PAGE_SQL},
    '(?is)<nav[^>]*>.*?</nav\s*>'), '(?is)<li[^>]*>.*?</li\s*>')) AS box,
    generate_subscripts(regexp_extract_all(regexp_extract({_CLEAN_PAGE_SQL},
    '(?is)<nav[^>]*>.*?</nav\s*>'), '(?is)<li[^>]*>.*?</li\s*>'), 1) AS nth FROM pages),
links AS (
  SELECT page_id, {_HOST_SQL} AS profile, nth,
         {_decode_sql("regexp_extract(box, '<a [^>]*href=" + '"([^"]*)"' + "', 1)")} AS href
  FROM boxes WHERE box LIKE '%<a %href=%'),
resolved AS (
  SELECT page_id, profile, nth, CASE WHEN regexp_matches(href, '^https?://.*\..*') THEN href
         ELSE 'http://' || profile || href END AS url FROM links)"""


@_query(f"WITH {_LINKS_SQL} SELECT DISTINCT profile, url FROM resolved WHERE nth <= 3")
def page_links(spark, sf):
    profiles = _profiles(spark, sf)
    return pages.extract_links(_pages(spark, sf, profiles), profiles, 3)[0]


@_query(f"WITH {_LINKS_SQL} SELECT DISTINCT profile, url FROM resolved WHERE nth <= 3")
def page_links_nested_rule(spark, sf):
    """The same links by a rule with parents, answered from the page tree."""
    profiles = _profiles(spark, sf, lists="body > nav", boxes="nav ul > li")
    return pages.extract_links(_pages(spark, sf, profiles), profiles, 3)[0]


@_query(rf"""WITH {_LINKS_SQL}
SELECT page_id, nth::BIGINT AS nth, href, regexp_matches(href, '^https?://.*\..*') AS valid, url,
       md5(url) AS id FROM resolved JOIN links USING (page_id, profile, nth)""")
def url_resolve(spark, sf):
    found = _table(spark, sf, "pages").select(
        "page_id",
        F.concat(F.lit("http://"), urls.url_host(F.col("url")), F.lit("/")).alias("root"),
        F.posexplode(
            F.regexp_extract_all("html", F.lit(r'<li><a href="([^"]*)"'), F.lit(1))
        ).alias("nth", "raw"),
    )
    href = found.select("*", html.decode_entities(F.col("raw")).alias("href"))
    url = urls.resolve_url(F.col("root"), F.col("href"))
    return href.select(
        "page_id",
        (F.col("nth") + 1).cast("bigint").alias("nth"),
        "href",
        urls.is_valid_url(F.col("href")).alias("valid"),
        url.alias("url"),
        urls.article_id(url).alias("id"),
    )


def _element_sql(tag: str) -> str:
    inner = rf"regexp_extract({_CLEAN_PAGE_SQL}, '(?is)<{tag}[^>]*>(.*?)</{tag}\s*>', 1)"
    return _decode_sql(f"regexp_replace({inner}, '{_TAG_SQL}', '', 'g')")


@_query(f"""SELECT page_id, {_element_sql('title')} AS title, {_element_sql('h1')} AS description,
'http://' || {_HOST_SQL} || '/favicon.ico' AS image_url, '{AS_OF}' AS publish_date FROM pages""")
def page_meta(spark, sf):
    profiles = _profiles(spark, sf)
    meta = pages.extract_meta(_pages(spark, sf, profiles), profiles, _ts(AS_OF))
    return meta.select(
        "page_id", "title", "description", "image_url", _stamp("publish_date").alias("publish_date")
    )


@_query("""SELECT page_id, 'Zoë "Z" ' || page_id AS author,
'2023-01-' || lpad((1 + page_id % 28)::VARCHAR, 2, '0') || ' 10:00:00' AS publish_date,
'json_ld' AS date_origin FROM pages""")
def json_ld_meta(spark, sf):
    """Author and date come from linked data added to each page, after a broken script."""
    profiles = _profiles(spark, sf)
    day = F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    script = F.concat(
        F.lit('<script type="application/ld+json">{broken</script>'),
        F.lit('<script type="application/ld+json">[ {"@type" : "Person",\n "url":"/p", "name" : "Zoë \\"Z\\" '),
        F.col("page_id"),
        F.lit('"}, {"datePublished": "2023-01-'),
        day,
        F.lit('T12:00:00+02:00"} ]</script></head>'),
    )
    found = _pages(spark, sf, profiles).withColumn(
        "html", F.replace(F.col("html"), F.lit("</head>"), script)
    )
    meta = pages.extract_meta(found, profiles, _ts(AS_OF))
    return meta.select(
        "page_id", "author", _stamp("publish_date").alias("publish_date"), "date_origin"
    )


@_query(f"WITH {_BLOCKS_SQL} SELECT page_id, pos::BIGINT AS pos, tag, text FROM blocks")
def page_content(spark, sf):
    profiles = _profiles(spark, sf)
    return pages.page_blocks(_pages(spark, sf, profiles), profiles).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


@_query(f"WITH {_BLOCKS_SQL} SELECT page_id, pos::BIGINT AS pos, tag, text FROM blocks")
def page_content_nested_rule(spark, sf):
    """The same content by a rule with parents, answered from the page tree."""
    profiles = _profiles(spark, sf, "body > article", ("body div.ad", "nav, footer"))
    return pages.page_blocks(_pages(spark, sf, profiles), profiles).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


_MARKDOWN_SQL = rf"""{_BLOCKS_SQL},
lines AS (SELECT page_id, pos, CASE WHEN tag = 'li' THEN '- ' WHEN tag = 'blockquote' THEN '> '
  WHEN regexp_full_match(tag, 'h[1-6]') THEN repeat('#', substr(tag, 2)::INT) || ' ' ELSE '' END ||
  regexp_replace(text, '\s+', ' ', 'g') AS line FROM blocks)
SELECT page_id, string_agg(line, chr(10) || chr(10) ORDER BY pos) AS markdown FROM lines GROUP BY page_id"""


@_query(f"WITH {_MARKDOWN_SQL}")
def page_markdown(spark, sf):
    profiles = _profiles(spark, sf)
    done = pages.pages_to_markdown(_pages(spark, sf, profiles), profiles)
    return done.select("page_id", "markdown")


@_query(f"""WITH boxes AS (
  SELECT page_id, unnest(regexp_extract_all(regexp_extract({_CLEAN_PAGE_SQL}, '(?is)<nav[^>]*>.*?</nav\\s*>'),
           '(?is)<li[^>]*>.*?</li\\s*>')) AS box,
         generate_subscripts(regexp_extract_all(regexp_extract({_CLEAN_PAGE_SQL}, '(?is)<nav[^>]*>.*?</nav\\s*>'),
           '(?is)<li[^>]*>.*?</li\\s*>'), 1) AS nth FROM pages)
SELECT page_id, string_agg('- ' || regexp_replace({_decode_sql("regexp_replace(box, '" + _TAG_SQL + "', '', 'g')")}, '\\s+', ' ', 'g')
  || ' (see ' || {_decode_sql("regexp_extract(box, 'href=" + '"([^"]*)"' + "', 1)")} || ')', chr(10) || chr(10) ORDER BY nth) AS markdown
FROM boxes GROUP BY page_id""")
def page_markdown_override(spark, sf):
    """The menu of each page, with links written out by a converter of the caller's."""
    profiles = _profiles(spark, sf, "nav", ())
    inline = html.default_inline()
    inline["a"] = lambda text, tag: F.concat(text, F.lit(" (see "), html.raw_attribute(tag, F.lit("href")), F.lit(")"))
    done = pages.pages_to_markdown(_pages(spark, sf, profiles), profiles, inline=inline)
    return done.filter("markdown <> ''").select("page_id", "markdown")


_BUILT_SQL = f"""{_BLOCKS_SQL},
texts AS (SELECT page_id, {_clean_sql("string_agg(text, chr(10) ORDER BY pos) || chr(10)")} AS content
          FROM blocks GROUP BY page_id),
words AS (SELECT page_id, {_tokens_sql('content')} AS toks FROM texts),
placed AS (SELECT page_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM words),
counted AS (SELECT page_id, token, count(*) AS n, min(pos) AS seen FROM placed
  WHERE token <> '' AND token NOT IN ({_COMMON_SQL}) GROUP BY page_id, token HAVING count(*) >= 3),
ranked AS (SELECT page_id, token, row_number() OVER (PARTITION BY page_id ORDER BY n DESC, seen) AS rank
           FROM counted),
tags AS (SELECT page_id, string_agg(token, ' ' ORDER BY rank) AS tags FROM ranked WHERE rank <= 10
         GROUP BY page_id)
SELECT md5(url) AS id, url, {_HOST_SQL} AS profile, upper({_HOST_SQL}) AS source,
       {_element_sql('title')} AS title, content, coalesce(tags, '') AS tags
FROM pages JOIN texts USING (page_id) LEFT JOIN tags USING (page_id)"""


@_query(f"WITH {_BUILT_SQL}")
def articles_built(spark, sf):
    profiles = _profiles(spark, sf)
    found = _pages(spark, sf, profiles)
    articles, _ = build.build_articles(found, profiles, COMMON, _ts(AS_OF))
    return articles.select(
        "id", "url", "profile", "source", "title", "content",
        F.array_join("tags.automatic", " ").alias("tags"),
    )


@_query("SELECT page_id, url, 'status 404' AS reason FROM pages WHERE contains(url, '?')")
def page_rejects(spark, sf):
    """Pages whose address has a query string count as not found."""
    status = F.when(F.contains(F.col("url"), F.lit("?")), F.lit(404)).otherwise(F.lit(200))
    crawled = _table(spark, sf, "pages").withColumn("status", status)
    return pages.split_by_status(crawled)[1].select("page_id", "url", "reason")


@_query(f"""SELECT url, CASE WHEN contains(url, '?') THEN 'status 404' ELSE 'no profile' END AS errors
FROM pages WHERE contains(url, '?') OR {_HOST_SQL} NOT LIKE 'm.%'""")
def build_rejects(spark, sf):
    """Only hosts starting with m have a profile, and addresses with a query string were not found."""
    profiles = _profiles(spark, sf)
    known = profiles.filter(F.col("source.profile_name").startswith("m."))
    status = F.when(F.contains(F.col("url"), F.lit("?")), F.lit(404)).otherwise(F.lit(200))
    found = _pages(spark, sf, known).withColumn("status", status)
    _, rejected = build.build_articles(found, known, COMMON, _ts(AS_OF))
    return rejected.select("url", F.array_join("errors", ",").alias("errors"))


# ------------------------------------------------------------------------- sources


@_query("""SELECT host AS profile, nth::BIGINT AS pos, 'tag:' || page_id AS url FROM (
  SELECT page_id, host, row_number() OVER (PARTITION BY host ORDER BY page_id) - 1 AS nth FROM (
    SELECT page_id, """ + _HOST_SQL + """ AS host FROM pages)) WHERE nth < 4""")
def feed_urls(spark, sf):
    return _feeds(spark, sf).transform(lambda f: readers.feed_urls(f, 4)).select(
        "profile", F.col("pos").cast("bigint").alias("pos"), "url"
    )


def _feeds(spark: SparkSession, sf: str) -> DataFrame:
    """One feed per host, listing its pages: RSS, or Atom when the host starts with m."""
    listed = (
        _table(spark, sf, "pages")
        .select(urls.url_host(F.col("url")).alias("profile"), "page_id")
        .groupBy("profile")
        .agg(F.sort_array(F.collect_list("page_id")).alias("ids"))
    )

    def entries(before: str, after: str) -> Column:
        item = F.transform(
            "ids", lambda i: F.concat(F.lit(before), i.cast("string"), F.lit(after))
        )
        return F.array_join(item, "")

    rss = F.concat(
        F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>x</title>'),
        entries('<item><title>t</title><guid isPermaLink="false">tag:', "</guid></item>"),
        F.lit("</channel></rss>"),
    )
    atom = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>x</title>'),
        entries("<entry><id>tag:", "</id></entry>"),
        F.lit("</feed>"),
    )
    xml = F.when(F.col("profile").startswith("m."), atom).otherwise(rss)
    return listed.select(
        "profile", F.concat(F.lit("http://"), "profile", F.lit("/feed")).alias("feed_url"), xml.alias("xml")
    )


@_query(f"""WITH {_LINKS_SQL},
fed AS (SELECT host AS profile, 'tag:' || page_id AS url FROM (
  SELECT page_id, host, row_number() OVER (PARTITION BY host ORDER BY page_id) AS nth FROM (
    SELECT page_id, {_HOST_SQL} AS host FROM pages)) WHERE nth <= 4 AND host LIKE 'm.%')
SELECT profile, url FROM fed
UNION ALL SELECT DISTINCT profile, url FROM resolved WHERE nth <= 4 AND profile NOT LIKE 'm.%'""")
def gather_urls(spark, sf):
    """Hosts starting with m are read by feed, the others by front page."""
    by_feed = F.when(F.col("host").startswith("m."), F.lit("rss"))
    profiles = _profiles(spark, sf, method=by_feed.otherwise(F.lit("dynamic")))
    found = _pages(spark, sf, profiles)
    return gather.gather_urls(profiles, _feeds(spark, sf), found, 4)[0]


@_query(f"""WITH hosts AS (SELECT DISTINCT {_HOST_SQL} AS profile FROM pages)
SELECT profile, CASE WHEN profile LIKE 'm.%' THEN 'no feed' ELSE 'no front page' END AS reason
FROM hosts WHERE length(profile) % 2 = 1""")
def gather_rejects(spark, sf):
    """Profiles of odd name length have neither feed nor front page."""
    by_feed = F.when(F.col("host").startswith("m."), F.lit("rss"))
    profiles = _profiles(spark, sf, method=by_feed.otherwise(F.lit("dynamic")))
    even = F.length("profile") % 2 == 0
    found, feeds = _pages(spark, sf, profiles).filter(even), _feeds(spark, sf).filter(even)
    return gather.gather_urls(profiles, feeds, found, 4)[1].select("profile", "reason")


@_query("""SELECT n_nationkey::BIGINT AS nation, 'https://' || lower(replace(n_name, ' ', '-')) ||
'.example/p/' || page AS url FROM nation, unnest(range(2, 7)) AS t(page)""")
def expand_url_template(spark, sf):
    seeds = _table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("nation"),
        F.concat(
            F.lit("https://"), F.replace(F.lower("n_name"), F.lit(" "), F.lit("-")), F.lit(".example/p/%")
        ).alias("template"),
    )
    return readers.expand_url_template(seeds, "template").select("nation", "url")


@_query("""SELECT DISTINCT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS token FROM benchmark""")
def word_list(spark, sf):
    path = scratch_dir(spark, "words")
    words = _table(spark, sf, "benchmark").select(
        F.explode(F.split("text", " ")).alias("w")
    )
    words.select(F.concat(F.lit("  "), "w", F.lit(" ")).alias("value")).write.text(path)
    return readers.read_word_list(spark, path)


def _markdown_files(spark: SparkSession, sf: str) -> DataFrame:
    """Markdown files holding the documents; those in German lack a title."""
    title = F.when(F.col("lang") == "de", F.lit("")).otherwise(
        F.concat(F.lit("title: 'It''s "), "doc_id", F.lit(": one'\n"))
    )
    return _table(spark, sf, "documents").select(
        F.concat(F.lit("/corpus/"), "source", F.lit("/"), "doc_id", F.lit(".md")).alias("path"),
        F.concat(
            F.lit("---\nid: doc-"), "doc_id", F.lit("\n"), title,
            F.lit("description: a text\n  in two lines\nsource: The "), "source", F.lit("\n---\n\n"), "text",
        ).alias("content"),
    )


_PARSED_SQL = rf"""
parsed AS (SELECT doc_id, 'doc-' || doc_id AS key, 'It''s ' || doc_id || ': one' AS title,
  'a text in two lines' AS description, 'The ' || source AS source,
  {_trim_sql('text')} AS content FROM documents WHERE lang <> 'de')"""


@_query(f"WITH {_PARSED_SQL} SELECT key AS id, title, description, source, content FROM parsed")
def markdown_corpus(spark, sf):
    good, _ = readers.parse_markdown(_markdown_files(spark, sf))
    return good.select("id", "title", "description", "source", "content")


@_query("""SELECT '/corpus/' || source || '/' || doc_id || '.md' AS file_path, 'title is missing' AS reason
FROM documents WHERE lang = 'de'""")
def markdown_rejects(spark, sf):
    _, bad = readers.parse_markdown(_markdown_files(spark, sf))
    return bad.select("file_path", F.array_join("errors", "; ").alias("reason"))


_LOADED_SQL = f"""{_PARSED_SQL},
loaded AS (SELECT md5(key) AS id, title, lower(replace(source, ' ', '')) AS profile, source AS author, content,
  strftime(TIMESTAMP '{START}' + to_seconds({_draw_sql('key', 5, SPAN)}), '%Y-%m-%d %H:%M:%S') AS publish_date
  FROM parsed)"""


@_query(f"""WITH {_LOADED_SQL}, {_ARTICLES_SQL.strip()}
SELECT id, title, profile, author, content, publish_date FROM loaded UNION ALL
SELECT id, title, profile, NULL, content, strftime(publish_date, '%Y-%m-%d %H:%M:%S') FROM articles""")
def load_corpus(spark, sf):
    good, _ = readers.parse_markdown(_markdown_files(spark, sf))
    store = merge.align_schema(_articles(spark, sf).drop("doc_id", "n_chars"), ARTICLE_SCHEMA)
    whole = jobs.load_corpus(store, good, _ts(START), _ts(END), 5)
    return whole.select(
        "id", "title", "profile", "author", "content", _stamp("publish_date").alias("publish_date")
    )


@_query("SELECT md5('doc-' || doc_id) AS id FROM documents WHERE lang = 'de'")
def delete_corpus(spark, sf):
    """A store keyed like the corpus loses every article that has a file."""
    good, _ = readers.parse_markdown(_markdown_files(spark, sf))
    store = _table(spark, sf, "documents").select(
        urls.article_id(F.concat(F.lit("doc-"), "doc_id")).alias("id")
    )
    return jobs.delete_corpus(store, good)


_PATH_SQL = "'/raw/' || doc_id || '.md'"


@_query(f"""WITH names AS (SELECT list(DISTINCT source ORDER BY source) AS names FROM documents)
SELECT {_PATH_SQL} AS path, md5(text) AS id, doc_id::VARCHAR AS title, 'about ' || doc_id AS description,
       names[{_draw_sql(_PATH_SQL, 3, '(len(names))')} + 1] AS source
FROM documents, names""")
def backfill_headers(spark, sf):
    docs = _table(spark, sf, "documents")
    path = F.concat(F.lit("/raw/"), "doc_id", F.lit(".md")).alias("path")
    files = docs.select(path, F.col("text").alias("content"))
    about = docs.select(path, F.concat(F.lit("about "), "doc_id").alias("description"))
    filled = jobs.backfill_headers(files, docs, about, 3)
    return filled.select("path", "id", "title", "description", "source")


@_query("SELECT doc_id, source, lower(replace('The ' || source, ' ', '')) AS slug FROM documents")
def profile_slugs(spark, sf):
    docs = _table(spark, sf, "documents")
    slug = urls.profile_slug(F.concat(F.lit("The "), "source"))
    return docs.select("doc_id", "source", slug.alias("slug"))


@_query(f"""WITH {_ARTICLES_SQL}
SELECT doc_id, strftime(publish_date, '%Y-%m-%d %H:%M:%S') AS publish_date FROM articles""")
def spread_dates(spark, sf):
    return _articles(spark, sf).select("doc_id", _stamp("publish_date").alias("publish_date"))


# ------------------------------------------------------------- presence and merging


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of the documents that have a label: stands for a stored corpus."""
    marks = _table(spark, sf, "labels").select("doc_id")
    return _articles(spark, sf).join(marks, "doc_id", "left_semi")


@_query(f"""WITH {_ARTICLES_SQL} SELECT doc_id, url FROM articles
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def not_stored(spark, sf):
    batch = _articles(spark, sf).select("doc_id", "url")
    return merge.not_stored(batch, _labelled(spark, sf)).select("doc_id", "url")


@_query(f"""WITH {_ARTICLES_SQL} SELECT doc_id, url FROM articles
WHERE doc_id IN (SELECT doc_id FROM labels)""")
def already_stored(spark, sf):
    batch = _articles(spark, sf).select("doc_id", "url")
    return merge.already_stored(batch, _labelled(spark, sf)).select("doc_id", "url")


@_query("""WITH batch AS (
  SELECT 'https://' || source || '.example.org/' || lang AS url, doc_id, n_chars FROM documents),
newest AS (SELECT url, doc_id, n_chars, row_number() OVER (PARTITION BY url ORDER BY n_chars DESC, doc_id DESC) AS nth
           FROM batch)
SELECT url, doc_id FROM newest WHERE nth = 1 AND url NOT IN (
  SELECT 'https://' || source || '.example.org/' || lang FROM documents JOIN labels USING (doc_id)
  WHERE toxic = 1)""")
def new_articles(spark, sf):
    """Many documents share an address here; addresses with toxic documents are stored."""
    url = F.concat(F.lit("https://"), "source", F.lit(".example.org/"), "lang").alias("url")
    docs = _table(spark, sf, "documents").select(url, "doc_id", "n_chars")
    toxic = _table(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    store = docs.join(toxic, "doc_id", "left_semi")
    fresh, _ = merge.new_articles(docs, store, ["n_chars", "doc_id"])
    return fresh.select("url", "doc_id")


@_query(f"""WITH {_ARTICLES_SQL},
batch AS (SELECT a.id, 'Revised ' || e.event_id AS title, e.event_id AS seq
          FROM events e JOIN articles a ON a.doc_id = e.user_id),
latest AS (SELECT id, title FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS nth
           FROM batch) WHERE nth = 1)
SELECT id, title FROM latest UNION ALL
SELECT id, title FROM articles WHERE id NOT IN (SELECT id FROM latest)""")
def upsert_latest(spark, sf):
    """Every event revises the article numbered like its user; the last one counts."""
    store = _articles(spark, sf).select("id", "title", "doc_id")
    events = _table(spark, sf, "events").select(
        F.col("user_id").alias("doc_id"),
        F.concat(F.lit("Revised "), "event_id").alias("title"),
        F.col("event_id").alias("seq"),
    )
    batch = events.join(store.select("id", "doc_id"), "doc_id").select("id", "title", "seq")
    saved = merge.upsert(store.select("id", "title"), batch, order=["seq"])
    return saved.select("id", "title")


@_query(f"""WITH {_ARTICLES_SQL}
SELECT a.id, CASE WHEN l.doc_id IS NULL THEN a.title WHEN l.toxic = 1 THEN NULL
  ELSE 'Checked ' || l.quality END AS title, a.description
FROM articles a LEFT JOIN labels l USING (doc_id)""")
def update_fields(spark, sf):
    """Labelled articles get a new title, toxic ones a null title; the rest stay."""
    store = _articles(spark, sf)
    title = F.when(F.col("toxic") == 0, F.concat(F.lit("Checked "), "quality"))
    batch = (
        _table(spark, sf, "labels")
        .join(store.select("doc_id", "id"), "doc_id")
        .select("id", title.alias("title"), F.lit("unused").alias("description"))
    )
    return merge.update_fields(store, batch, ["title"]).select("id", "title", "description")


@_query(f"""WITH {_ARTICLES_SQL},
seen AS (SELECT user_id AS doc_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS nth FROM events)
SELECT a.doc_id, event_type AS token, round(e.value, 6) AS weight FROM articles a
JOIN seen s ON s.doc_id = a.doc_id AND nth = 1 JOIN events e USING (event_id)
UNION ALL SELECT doc_id, 'old', doc_id::DOUBLE FROM articles WHERE doc_id NOT IN (SELECT user_id FROM events)""")
def update_fields_vectors(spark, sf):
    """Each event brings a new sparse vector for the article numbered like its user; the last one counts."""
    old = F.create_map(F.lit("old"), F.col("doc_id").cast("double"))
    store = _articles(spark, sf).select("doc_id", "id", F.struct(old.alias("elser")).alias("embeddings"))
    fresh = F.create_map(F.col("event_type"), F.round("value", 6))
    batch = (
        _table(spark, sf, "events")
        .withColumn("embeddings", F.struct(fresh.alias("elser")))
        .select(F.col("user_id").alias("doc_id"), "event_id", "embeddings")
        .join(store.select("doc_id", "id"), "doc_id")
    )
    done = merge.update_fields(store, batch, ["embeddings"], order=["event_id"])
    return done.select("doc_id", F.explode("embeddings.elser").alias("token", "weight"))


def _copied(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    source = merge.align_schema(_judged(spark, sf), ARTICLE_SCHEMA).withColumn(
        "read_times", F.col("n_chars")
    )
    target = merge.align_schema(_labelled(spark, sf), ARTICLE_SCHEMA)
    return merge.copy_fields(source, target, COPIED_FIELDS)


@_query(f"""WITH {_ML_SQL}
SELECT id, coalesce(label, '') AS labels, incident, n_chars AS read_times FROM judged
WHERE doc_id IN (SELECT doc_id FROM labels)""")
def copy_fields(spark, sf):
    updated, _ = _copied(spark, sf)
    return updated.select(
        "id",
        F.array_join("ml.labels", ",").alias("labels"),
        F.col("ml.incident").alias("incident"),
        "read_times",
    )


@_query(f"""WITH {_ARTICLES_SQL} SELECT url FROM articles
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def copy_fields_absent(spark, sf):
    return _copied(spark, sf)[1]


@_query(f"""WITH {_ARTICLES_SQL} SELECT id FROM articles
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def delete_by_id(spark, sf):
    store = _articles(spark, sf)
    toxic = _table(spark, sf, "labels").filter("toxic = 1")
    ids = store.join(toxic, "doc_id", "left_semi").select("id")
    return merge.delete_by_id(store, ids).select("id")


@_query("""WITH store AS (
  SELECT page_id, url, CASE WHEN contains(url, '#') THEN md5(reverse(url)) ELSE md5(url) END AS id FROM pages),
ranked AS (SELECT md5(url) AS new_id, url, page_id, row_number() OVER (
    PARTITION BY url ORDER BY (id <> md5(url))::INT DESC, page_id DESC) AS nth FROM store)
SELECT new_id AS id, url, page_id FROM ranked WHERE nth = 1""")
def rekey(spark, sf):
    """Pages whose address has a fragment carry a wrong id."""
    url = F.col("url")
    wrong = F.contains(url, F.lit("#"))
    store = _table(spark, sf, "pages").select(
        F.when(wrong, F.md5(F.reverse(url))).otherwise(F.md5(url)).alias("id"), "url", "page_id"
    )
    return merge.rekey(merge.latest_per_key(store, "url", ["page_id"]), ["page_id"])


_ZONED_SQL = """CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
  WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || 'Z' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END"""


def _zoned(spark: SparkSession, sf: str) -> DataFrame:
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_type")
    raw = (
        F.when(kind == "click", F.concat(iso, F.lit("+02:00")))
        .when(kind == "view", F.concat(F.replace(iso, F.lit("T"), F.lit(" ")), F.lit("Z")))
        .otherwise(iso)
    )
    return _table(spark, sf, "events").select(
        F.col("event_id").alias("id"), raw.alias("publish_date"), raw.alias("inserted_at")
    )


@_query("""SELECT event_id AS id, strftime(CASE event_type WHEN 'click' THEN ts - INTERVAL 2 HOUR ELSE ts END,
  '%Y-%m-%d %H:%M:%S') AS publish_date FROM events""")
def add_timezone(spark, sf):
    done, _ = jobs.add_timezone(_zoned(spark, sf))
    return done.select("id", _stamp("publish_date").alias("publish_date"))


@_query("""SELECT event_id AS id, 'on ' || event_type AS publish_date, 'publish_date is not a date' AS reason
FROM events WHERE event_type = 'click'""")
def add_timezone_rejects(spark, sf):
    """Articles with a date that cannot be read come back as they were."""
    text = F.when(F.col("publish_date").endswith("+02:00"), F.lit("on click")).otherwise(F.col("publish_date"))
    _, rejected = jobs.add_timezone(_zoned(spark, sf).withColumn("publish_date", text))
    return rejected.select("id", "publish_date", "reason")


@_query("""SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS publish_date FROM events
WHERE event_type NOT IN ('click', 'view')""")
def add_timezone_modified(spark, sf):
    """Only the articles whose dates had no zone, as they are written back."""
    done = jobs.modified_dates(_zoned(spark, sf))
    return done.select("id", _stamp("publish_date").alias("publish_date"))


@_query(f"""WITH {_ARTICLES_SQL}
SELECT id, title, NULL AS summary, 0 AS incident FROM articles""")
def align_schema(spark, sf):
    """An older table without half of the properties."""
    old = _articles(spark, sf).select("id", "title", F.struct(F.lit("x").alias("odd")).alias("tags"))
    grown = merge.align_schema(old, ARTICLE_SCHEMA)
    incident = F.coalesce("ml.incident", F.lit(0))
    return grown.select("id", "title", "summary", incident.alias("incident"))


@_query("""SELECT doc_id, text, NULL AS title_vector FROM documents""")
def without_vectors(spark, sf):
    vector = F.create_map(F.col("lang"), F.lit(1.0).cast("float"))
    chunk = F.struct(F.col("text").alias("text"), vector.alias("elser"))
    articles = _table(spark, sf, "documents").select(
        "doc_id",
        F.struct(
            F.struct(vector.alias("elser"), F.lit(None).cast("string").alias("kept")).alias("title"),
            F.struct(vector.alias("elser"), F.lit(None).cast("string").alias("kept")).alias("description"),
            F.array(chunk).alias("content_chunks"),
        ).alias("embeddings"),
    )
    bare = corpus.without_vectors(articles)
    assert bare.schema["embeddings"].dataType["title"].dataType.fieldNames() == ["kept"]
    return bare.select(
        "doc_id",
        F.get("embeddings.content_chunks", F.lit(0))["text"].alias("text"),
        F.col("embeddings.title.kept").alias("title_vector"),
    )


# --------------------------------------------------------------- quality and labels


def _doubtful(spark: SparkSession, sf: str) -> DataFrame:
    """Articles with broken fields, decided by their language and length."""
    docs = _table(spark, sf, "documents")
    lang = F.col("lang")
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(lang == "es", F.lit("")).otherwise(F.concat(F.lit("Document "), "doc_id")).alias("title"),
        F.when(F.col("n_chars") < 300, F.lit(None)).otherwise(lang).alias("description"),
        F.concat(F.when(lang == "de", F.lit("ftp")).otherwise(F.lit("https")), F.lit("://a.b/"), "doc_id").alias("url"),
        F.when(F.col("n_chars") > 5000, F.lit("2999-01-01")).otherwise(F.lit("2024-01-01")).alias("publish_date"),
    )


_ERRORS_SQL = """
errors AS (
  SELECT doc_id::VARCHAR AS id, 'title' AS field, 'is required' AS message FROM documents WHERE lang = 'es'
  UNION ALL SELECT doc_id::VARCHAR, 'description', 'is required' FROM documents WHERE n_chars < 300
  UNION ALL SELECT doc_id::VARCHAR, 'url', 'is not an http address' FROM documents WHERE lang = 'de'
  UNION ALL SELECT doc_id::VARCHAR, 'publish_date', 'is in the future' FROM documents WHERE n_chars > 5000)"""


@_query(f"""WITH {_ERRORS_SQL}
SELECT d.doc_id::VARCHAR AS id, e.field, e.message FROM documents d LEFT JOIN errors e ON e.id = d.doc_id::VARCHAR""")
def validate_split(spark, sf):
    """Valid articles with a null field, invalid ones with each of their errors."""
    good, bad = quality.validate(_doubtful(spark, sf), quality.article_rules(_ts(AS_OF)))
    listed = bad.select("id", F.inline_outer("errors")).filter("field is not null")
    none = F.lit(None).cast("string")
    return good.select("id", none.alias("field"), none.alias("message")).unionByName(listed)


@_query(f"""WITH {_ERRORS_SQL},
fixable AS (SELECT id FROM errors GROUP BY id HAVING bool_and(field IN ('title', 'url')))
SELECT f.id, CASE WHEN lang = 'es' THEN 'Sin título' ELSE 'Document ' || doc_id END AS title,
  CASE WHEN lang = 'de' THEN 'http://fixed.example/' || doc_id ELSE 'https://a.b/' || doc_id END AS url
FROM fixable f JOIN documents d ON f.id = d.doc_id::VARCHAR
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def apply_corrections(spark, sf):
    """Titles and addresses are corrected, toxic documents are deleted."""
    rules = quality.article_rules(_ts(AS_OF))
    _, bad = quality.validate(_doubtful(spark, sf), rules)
    fields = F.inline(
        F.array(
            F.struct(F.lit("es").alias("lang"), F.lit("title").alias("field"), F.lit("Sin título").alias("text")),
            F.struct(F.lit("de").alias("lang"), F.lit("url").alias("field"), F.lit("http://fixed.example/").alias("text")),
        )
    )
    decided = _table(spark, sf, "documents").select("doc_id", F.col("lang").alias("own"), fields)
    number = F.when(F.col("field") == "url", F.col("doc_id").cast("string")).otherwise(F.lit(""))
    fixes = decided.filter("own = lang").select(
        F.col("doc_id").cast("string").alias("id"), "field", F.concat("text", number).alias("new_value")
    )
    deletes = (
        _table(spark, sf, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))
    )
    good, _ = quality.apply_corrections(bad, fixes, deletes, rules, ["title", "url"])
    return good.select("id", "title", "url")


@_query("""WITH bad AS (SELECT doc_id FROM documents WHERE lang = 'es'),
ranked AS (SELECT user_id AS doc_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS nth FROM events)
SELECT doc_id::VARCHAR AS id, 'Fix ' || event_id AS title FROM bad JOIN ranked USING (doc_id) WHERE nth = 1""")
def corrections_repeated(spark, sf):
    """Untitled articles get a title from every event of the user of their number; the last one counts."""
    docs = _table(spark, sf, "documents")
    bad = docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(F.col("lang") == "es", F.lit("")).otherwise(F.lit("x")).alias("title"),
    )
    rules = {"title": [("is required", F.col("title") != "")]}
    _, bad = quality.validate(bad, rules)
    fixes = _table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("id"), F.lit("title").alias("field"),
        F.concat(F.lit("Fix "), "event_id").alias("new_value"), "event_id",
    )
    good, _ = quality.apply_corrections(bad, fixes, fixes.limit(0), rules, ["title"], order=["event_id"])
    return good.select("id", "title")


@_query("""WITH bad AS (SELECT doc_id::VARCHAR AS id FROM documents WHERE lang = 'es')
SELECT event_id, CASE WHEN event_type = 'view' THEN 'not a field to correct' ELSE 'no such row' END AS reason
FROM events WHERE event_type = 'view' OR user_id::VARCHAR NOT IN (SELECT id FROM bad)""")
def corrections_unused(spark, sf):
    """Fixes of another field, and those of articles that are not invalid, are reported."""
    bad = _table(spark, sf, "documents").filter("lang = 'es'").select(F.col("doc_id").cast("string").alias("id"), F.lit("").alias("title"))
    field = F.when(F.col("event_type") == "view", F.lit("summary")).otherwise(F.lit("title"))
    fixes = _table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("id"), field.alias("field"), F.lit("x").alias("new_value"), "event_id"
    )
    return quality.unused_corrections(bad, fixes, ["title"]).select("event_id", "reason")


@_query(f"""SELECT DISTINCT {_HOST_SQL} AS profile, 'more-' || length({_HOST_SQL}) AS name FROM pages
WHERE length({_HOST_SQL}) NOT IN (SELECT length(lower(n_name)) + 8 FROM nation)""")
def verify_references(spark, sf):
    files = _table(spark, sf, "nation").select(
        F.concat(F.lit("more-"), F.length("n_name") + 8).alias("name")
    )
    known = files.unionByName(files.select(F.lit("consent").alias("name")))
    return quality.missing_references(_profiles(spark, sf), known)


@_query(f"""SELECT h.profile, count(p.url) AS urls FROM (SELECT DISTINCT {_HOST_SQL} AS profile FROM pages) h
LEFT JOIN (SELECT {_HOST_SQL} AS profile, url FROM pages WHERE contains(url, '?')) p USING (profile) GROUP BY h.profile""")
def url_counts(spark, sf):
    found = _table(spark, sf, "pages").select(urls.url_host(F.col("url")).alias("profile"), "url")
    return quality.url_counts(
        found.select("profile"), found.filter(F.contains(F.col("url"), F.lit("?")))
    )


@_query(f"""SELECT {_HOST_SQL} AS profile, count(*) FILTER (WHERE contains(html, '<!-- ad 1')) AS success,
count(*) FILTER (WHERE NOT contains(html, '<!-- ad 1')) AS failure FROM pages GROUP BY ALL""")
def parse_success(spark, sf):
    """Pages without a certain comment lose their heading and so fail."""
    profiles = _profiles(spark, sf)
    kept = F.contains(F.col("html"), F.lit("<!-- ad 1"))
    damaged = F.regexp_replace("html", "</?h1>", "")
    found = _pages(spark, sf, profiles).withColumn(
        "html", F.when(kept, F.col("html")).otherwise(damaged)
    )
    results = build.parse_results(found, profiles, _ts(AS_OF))
    names = profiles.select(F.col("source.profile_name").alias("profile"))
    return quality.parse_success(names, results)


@_query("SELECT DISTINCT source FROM documents")
def unique_sources(spark, sf):
    return quality.unique_values(_table(spark, sf, "documents"), "source")


@_query(f"""WITH {_ARTICLES_SQL} SELECT count(*) AS left_over FROM articles
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def urls_left(spark, sf):
    batch = _articles(spark, sf).select("url")
    left = merge.not_stored(batch, _labelled(spark, sf))
    return left.agg(F.count("url").alias("left_over"))


@_query("""SELECT count(*) AS rows, count(*) FILTER (WHERE event_type NOT IN ('click', 'view')) AS modified
FROM events""")
def run_report(spark, sf):
    """Counts taken while the rows pass through a write."""
    naive = dates.was_naive(F.col("publish_date"))
    seen, report = quality.observed(_zoned(spark, sf), "zones", modified=naive)
    seen.write.format("noop").mode("overwrite").save()
    counts = report.get
    return spark.range(1).select(
        F.lit(counts["rows"]).alias("rows"), F.lit(counts["modified"]).alias("modified")
    )


@_query(f"""WITH {_ML_SQL},
newest AS (SELECT id, title, label FROM judged ORDER BY publish_date DESC, id LIMIT 200)
SELECT id, title FROM newest WHERE label IS NULL""")
def label_queue(spark, sf):
    """The limit is the feature: it cuts the 200 newest from all articles."""
    return labels.label_queue(_judged(spark, sf), 200).select("id", "title")


@_query(f"WITH {_ML_SQL} SELECT id, title FROM judged WHERE incident = 0")
def incident_queue(spark, sf):
    return labels.incident_queue(_judged(spark, sf)).select("id", "title")


@_query(f"""WITH {_ARTICLES_SQL} SELECT id, title FROM articles WHERE profile IN ('src1', 'src2')
ORDER BY publish_date, id LIMIT 25""")
def query_articles(spark, sf):
    return labels.query_articles(
        _articles(spark, sf), 25, "publish_date", "asc", ["src1", "src2"], ["title"]
    )


@_query(f"""WITH {_ERRORS_SQL},
found AS (SELECT doc_id::VARCHAR AS id FROM documents WHERE source IN ('src1', 'src2'))
SELECT id, coalesce(field, 'valid') AS field FROM found LEFT JOIN errors USING (id)""")
def query_checked(spark, sf):
    """The articles of two sources, valid ones and each error of the others."""
    sources = _table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("profile"))
    articles = _doubtful(spark, sf).join(sources, "id")
    rules = quality.article_rules(_ts(AS_OF))
    good, bad = quality.query_checked(articles, rules, sources=["src1", "src2"], fields=["title"])
    listed = bad.select("id", F.inline_outer("errors")).select("id", "field")
    return good.select("id", F.lit("valid").alias("field")).unionByName(listed)


_CHOICE_SQL = """CASE WHEN quality = 1 AND toxic = 1 THEN '0, 3' WHEN quality = 1 THEN '6'
  WHEN toxic = 1 THEN '7' ELSE '' END"""


def _choices(spark: SparkSession, sf: str) -> DataFrame:
    quality_, toxic = F.col("quality") == 1, F.col("toxic") == 1
    choice = (
        F.when(quality_ & toxic, F.lit("0, 3")).when(quality_, F.lit("6")).when(toxic, F.lit("7"))
    )
    articles = _judged(spark, sf).select("doc_id", "id")
    return _table(spark, sf, "labels").join(articles, "doc_id").select(
        "id", F.coalesce(choice, F.lit("")).alias("choice"), toxic.alias("is_incident")
    )


@_query(f"""WITH {_ML_SQL}
SELECT id, CASE {_CHOICE_SQL} WHEN '0, 3' THEN 'trends,research' WHEN '6' THEN 'malware'
  WHEN '' THEN CASE WHEN l.doc_id IS NULL THEN coalesce(label, '') ELSE 'none' END
  ELSE coalesce(label, '') END AS labels, incident
FROM judged LEFT JOIN labels l USING (doc_id)""")
def apply_labels(spark, sf):
    done, _ = labels.apply_labels(_judged(spark, sf), _choices(spark, sf))
    return done.select(
        "id", F.array_join("ml.labels", ",").alias("labels"), F.col("ml.incident").alias("incident")
    )


@_query(f"""WITH {_ARTICLES_SQL} SELECT id, '7' AS choice FROM articles JOIN labels USING (doc_id)
WHERE toxic = 1 AND quality <> 1""")
def apply_labels_rejects(spark, sf):
    _, rejected = labels.apply_labels(_judged(spark, sf), _choices(spark, sf))
    return rejected.select("id", "choice")


@_query(f"""WITH {_ML_SQL}
SELECT id, CASE WHEN l.doc_id IS NULL THEN incident WHEN toxic = 1 THEN 2 ELSE 1 END AS incident
FROM judged LEFT JOIN labels l USING (doc_id)""")
def apply_incident(spark, sf):
    done = labels.apply_incident(_judged(spark, sf), _choices(spark, sf))
    return done.select("id", F.col("ml.incident").alias("incident"))


@_query(f"""WITH {_ML_SQL},
last AS (SELECT user_id AS doc_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS nth
         FROM events WHERE event_id % 10 < 7),
named AS (SELECT doc_id, list_extract(['trends', 'vulnerability', 'incident', 'research', 'apt', 'ransomware group', 'malware'],
                                      (event_id % 10)::INT + 1) AS name FROM last WHERE nth = 1)
SELECT id, coalesce(n.name, label, '') AS labels FROM judged LEFT JOIN named n USING (doc_id)""")
def apply_labels_repeated(spark, sf):
    """Every event is a decision on the article of its user; the last readable one counts."""
    articles = _judged(spark, sf)
    decisions = _table(spark, sf, "events").select(
        F.col("user_id").alias("doc_id"), (F.col("event_id") % 10).cast("string").alias("choice"), "event_id"
    )
    decisions = decisions.join(articles.select("doc_id", "id"), "doc_id").select("id", "choice", "event_id")
    done, _ = labels.apply_labels(articles, decisions, order=["event_id"])
    return done.select("id", F.array_join("ml.labels", ",").alias("labels"))


# ------------------------------------------------------------ exports and the store

_PLAIN_SQL = f"""WITH {_ARTICLES_SQL}
SELECT id, title, url, content, strftime(publish_date, '%Y-%m-%d %H:%M:%S') AS publish_date FROM articles"""


def _whole(spark: SparkSession, sf: str) -> DataFrame:
    return merge.align_schema(_articles(spark, sf).drop("doc_id", "n_chars"), ARTICLE_SCHEMA)


def _plain(articles: DataFrame) -> DataFrame:
    return articles.select(
        "id", "title", "url", "content", _stamp("publish_date").alias("publish_date")
    )


@_query(_PLAIN_SQL)
def json_roundtrip(spark, sf):
    path = scratch_dir(spark, "json")
    writers.write_articles_json(_whole(spark, sf), path)
    return _plain(readers.read_articles_json(spark, path))


@_query(_PLAIN_SQL.replace("AS publish_date FROM", "AS publish_date, 'articles' AS index FROM"))
def backup(spark, sf):
    path = scratch_dir(spark, "backup")
    found = _whole(spark, sf).withColumn("highlights", F.col("content"))
    writers.write_backup({"articles": found}, path)
    saved = spark.read.schema(found.schema).json(path)
    return _plain(saved.filter("highlights is null")).withColumn("index", F.lit("articles"))


@_query(f"""WITH {_ARTICLES_SQL},
latest AS (SELECT user_id AS doc_id, max(event_id) AS seq FROM events WHERE user_id % 9 = 4 GROUP BY user_id)
SELECT id, coalesce('Revised ' || seq, title) AS title, CASE WHEN l.doc_id IS NULL THEN description ELSE 'quality ' || quality END AS description
FROM articles a LEFT JOIN latest USING (doc_id) LEFT JOIN labels l ON l.doc_id = a.doc_id
WHERE a.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def store_update(spark, sf):
    """A store of buckets after an upsert, an update of one field and a removal."""
    whole = merge.align_schema(_articles(spark, sf).withColumnRenamed("n_chars", "read_times"), ARTICLE_SCHEMA)
    whole = whole.select("doc_id", *ARTICLE_SCHEMA.fieldNames())
    store = BucketStore(spark, scratch_dir(spark, "buckets"), buckets=16)
    store.create(whole.drop("doc_id"))
    events = _table(spark, sf, "events").filter("user_id % 9 = 4").select(F.col("user_id").alias("doc_id"), "event_id")
    revised = whole.join(events, "doc_id").withColumn("title", F.concat(F.lit("Revised "), "event_id"))
    store.upsert(revised.drop("doc_id"), order=["event_id"])
    marks = _table(spark, sf, "labels").join(whole.select("doc_id", "id"), "doc_id")
    store.update_fields(marks.select("id", F.concat(F.lit("quality "), "quality").alias("description")), ["description"])
    store.delete(marks.filter("toxic = 1").select("id"))
    return store.read().select("id", "title", "description")


@_query("""SELECT event_id, k FROM (SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events)""")
def raw_backup(spark, sf):
    """Event properties as untyped documents of a second store."""
    path = scratch_dir(spark, "raw")
    raw = _table(spark, sf, "events").select(
        F.to_json(F.struct("event_id", "props")).alias("value")
    )
    writers.write_raw_backup(raw, path)
    saved = readers.read_raw_documents(spark, path)
    return saved.select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
        F.get_json_object(F.get_json_object("value", "$.props"), "$.k").cast("bigint").alias("k"),
    )


@_query(f"""WITH {_ARTICLES_SQL}
SELECT profile, id, '# ' || title || chr(10) || chr(10) || '> ' || description || chr(10) || chr(10) ||
  '**Source:** ' || source || '  ' || chr(10) || '**Published:** ' || strftime(publish_date, '%Y-%m-%d %H:%M:%S') ||
  '  ' || chr(10) || '**Address:** ' || url AS markdown FROM articles""")
def markdown_export(spark, sf):
    path = scratch_dir(spark, "markdown")
    writers.write_markdown(_whole(spark, sf), path)
    return spark.read.parquet(path).select("profile", "id", "markdown")


@_query(f"""WITH {_ARTICLES_SQL} SELECT id, url FROM articles
WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND n_chars >= 300""")
def import_articles(spark, sf):
    """Short documents lose their description and so are rejected."""
    described = F.when(F.col("n_chars") >= 300, F.col("description"))
    batch = merge.align_schema(
        _articles(spark, sf).withColumn("description", described), ARTICLE_SCHEMA
    )
    good, _ = jobs.import_articles(batch, _labelled(spark, sf), _ts(AS_OF))
    return good.select("id", "url")


@_query("SELECT DISTINCT md5(url) AS id, url FROM pages")
def incremental_ingest(spark, sf):
    """Pages arrive in two files; a third run and a repeated file add nothing."""
    root = scratch_dir(spark, "ingest")
    profiles = _profiles(spark, sf)
    crawled = _table(spark, sf, "pages")
    store = ArticleStore(spark, f"{root}/store")

    def run() -> None:
        ingest_incremental(
            spark, f"{root}/pages", crawled.schema, profiles, COMMON, store,
            f"{root}/checkpoint", _ts(AS_OF),
        )

    query_pages = F.contains(F.col("url"), F.lit("?"))
    crawled.filter(query_pages).write.mode("append").parquet(f"{root}/pages")
    run()
    crawled.write.mode("append").parquet(f"{root}/pages")
    run()
    run()
    return store.read().select("id", "url")


@_query(f"""SELECT url, CASE WHEN contains(url, '?') THEN 'status 404' ELSE 'no profile' END AS errors FROM (
  SELECT DISTINCT url FROM pages WHERE contains(url, '?') OR {_HOST_SQL} NOT LIKE 'm.%')""")
def ingest_rejects(spark, sf):
    """What the ingest writes of pages that were not found or have no profile."""
    root = scratch_dir(spark, "ingest")
    profiles = _profiles(spark, sf)
    known = profiles.filter(F.col("source.profile_name").startswith("m."))
    status = F.when(F.contains(F.col("url"), F.lit("?")), F.lit(404)).otherwise(F.lit(200))
    crawled = _table(spark, sf, "pages").withColumn("status", status)
    crawled.write.parquet(f"{root}/pages")
    ingest_incremental(
        spark, f"{root}/pages", crawled.schema, known, COMMON, ArticleStore(spark, f"{root}/store"),
        f"{root}/checkpoint", _ts(AS_OF),
    )
    rejected = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/checkpoint-rejects")
    return rejected.select("url", F.array_join("errors", ",").alias("errors")).distinct()
