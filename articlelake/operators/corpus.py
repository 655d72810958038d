"""Keyword tags, indicators and sparse vectors over a corpus of documents.

Computed arrays are unpacked by the outer forms of explode: for the plain forms
Spark adds a size test below, which computes the whole array a second time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import weights
from ..functions.binding import let
from ..functions.indicators import Indicator, extract_indicators
from ..functions.tags import frequent_tokens, without_words
from ..functions.text import clean_text, clean_texts, spaced_words, tokenize
from ..session import broadcast_if_bounded, scratch_dir


def token_counts(docs: DataFrame, key: str = "id", text: str = "content") -> DataFrame:
    """Occurrences and first position of each token of each document.

    Words of a document that is one row, as most are, are counted there and do not
    move. Rows that share a key meet by (document, token), counted first, so a key of
    very many rows spreads.
    """
    placed = F.transform(tokenize(F.col(text)), lambda t, i: F.struct(t.alias("token"), i.alias("pos")))
    own = let(F.sort_array(placed), lambda w: F.when(F.size(w) > 0, _placed_runs(w)))
    repeated = docs.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1")
    repeated = broadcast_if_bounded(repeated.select("__key"))
    same = F.col(key).eqNullSafe(F.col("__key"))

    def counted(rows: DataFrame) -> DataFrame:
        return rows.select(key, F.inline_outer(own)).filter("token is not null")

    single = counted(docs.join(repeated, same, "left_anti"))
    shared = counted(docs.join(repeated, same, "left_semi")).groupBy(key, "token").agg(
        F.sum("n").alias("n"), F.min("first_pos").alias("first_pos")
    )
    return single.unionByName(shared)


def with_top_tags(
    docs: DataFrame,
    common_words: Sequence[str] | DataFrame,
    text: str = "content",
    k: int = 10,
    min_count: int = 3,
    key: str = "id",
    out: str = "automatic",
) -> DataFrame:
    """Add the most frequent uncommon words of each document, best first.

    A sequence of words is tested inside the row, which needs no shuffle at
    all; a one-column table is joined by token.
    """
    if isinstance(common_words, DataFrame):
        words = common_words.select(F.col(common_words.columns[0]).alias("token"))
        return _joined_top_tags(docs, words, text, k, min_count, key, out)
    words = without_words(tokenize(F.col(text)), common_words)
    best = frequent_tokens(words, k, min_count)
    return docs.withColumn(out, F.transform(best, lambda t: t["token"]))


def _joined_top_tags(docs, words, text, k, min_count, key, out) -> DataFrame:
    """A document is known by key and text, so that repeated or null keys get their own tags."""
    # Only frequent tokens meet the word list; few of a document's tokens do.
    tokens = without_words(tokenize(F.col(text)), [])
    keyed = docs.withColumn("__text", F.md5(text))
    frequent = (
        keyed.select(F.col(key).alias("__k"), F.col("__text").alias("__t"), F.inline_outer(frequent_tokens(tokens, None, min_count)))
        .filter("token is not null")
        .distinct()
        .join(words.filter("token is not null").distinct(), "token", "left_anti")
    )
    order = W.partitionBy("__k", "__t").orderBy(F.desc("n"), "seen")
    best = (
        frequent.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .groupBy("__k", "__t")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "token"))).alias("best"))
        .select("__k", "__t", F.transform("best", lambda b: b["token"]).alias("__best"))
    )
    same = keyed[key].eqNullSafe(best["__k"]) & (keyed["__text"] == best["__t"])
    none = F.array().cast("array<string>")
    tags = F.coalesce("__best", none)
    return keyed.join(best, same, "left").withColumn(out, tags).drop("__text", "__k", "__t", "__best")


def with_indicators(
    docs: DataFrame,
    text: str = "content",
    indicators: Mapping[str, Indicator] | None = None,
    out: str = "interesting",
) -> DataFrame:
    """Add the non-empty indicator groups of each document."""
    return docs.withColumn(out, extract_indicators(F.col(text), indicators))


def indicators_long(
    docs: DataFrame,
    key: str = "id",
    text: str = "content",
    indicators: Mapping[str, Indicator] | None = None,
) -> DataFrame:
    """One row per document, group and value."""
    return (
        with_indicators(docs, text, indicators, "__found")
        .select(key, F.inline_outer("__found"))
        .select(key, "name", F.explode_outer("values").alias("value"))
        .filter("value is not null")
    )


def with_tags(
    docs: DataFrame,
    common_words: Sequence[str] | DataFrame,
    text: str = "content",
    key: str = "id",
    indicators: Mapping[str, Indicator] | None = None,
) -> DataFrame:
    """Add `tags`: keyword tags and indicators of cleaned text."""
    tagged = with_top_tags(docs, common_words, text, key=key, out="__auto")
    found = extract_indicators(F.col(text), indicators)
    tags = F.struct(F.col("__auto").alias("automatic"), found.alias("interesting"))
    return tagged.withColumn("tags", tags).drop("__auto")


# ------------------------------------------------------------------ sparse vectors

Weigher = Callable[[Column], Column]

def _words(cleaned: Column) -> Column:
    return F.filter(tokenize(cleaned), lambda t: t != "")


def document_frequencies(texts: DataFrame, text: str = "text") -> DataFrame:
    """`(token, df)`: in how many texts each token occurs."""
    words = F.array_distinct(_words(clean_text(F.col(text))))
    return (
        texts.select(F.explode_outer(words).alias("token"))
        .filter("token is not null")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def _texts(articles: DataFrame) -> Column:
    """Title, description and chunk texts of an article, in this order."""
    chunks = F.transform("embeddings.content_chunks", lambda c: c["text"])
    none = F.array().cast("array<string>")
    return F.concat(F.array("title", "description"), F.coalesce(chunks, none))


def article_texts(articles: DataFrame) -> DataFrame:
    """Every text that gets a vector: titles, descriptions and content chunks."""
    return articles.select(F.explode(_texts(articles)).alias("text")).filter("text is not null")


def sparse_embed(articles: DataFrame, model: Weigher | None = None) -> DataFrame:
    """Replace all vectors of `embeddings` by fresh ones.

    `model` maps a text column to `map<string,float>`; it may be a pandas UDF. One that
    has a method `of_lists`, as `model_weigher` makes it, weighs all texts of an article
    in its row, which needs no shuffle. Without a model, weights are TF-IDF over the
    articles' own texts, by the exact number of texts that hold a token. Articles
    without chunks keep a null chunk list. Articles that share an id, or have none,
    get their own vectors.
    """
    if model is None:
        return _with_vectors(_tfidf(articles))
    if hasattr(model, "of_lists"):
        return _with_vectors(articles.withColumn("__vectors", model.of_lists(_texts(articles))))
    # Articles move once, with their texts weighed on the way; each is its own group.
    whole = F.struct(*[F.col(f"`{c}`") for c in articles.columns])
    texts = F.transform(_texts(articles), lambda t, i: F.struct(t.alias("text"), F.when(i == 0, whole).alias("all")))
    placed = articles.select(F.monotonically_increasing_id().alias("__row"), texts.alias("__parts"))
    parts = placed.select("__row", F.posexplode_outer("__parts").alias("at", "part"))
    entry = F.struct("at", F.map_entries(model(F.col("part.text"))).alias("elser"))
    rows = parts.select("__row", F.col("part.all").alias("all"), entry.alias("entry")).groupBy("__row").agg(
        F.first("all", ignorenulls=True).alias("__all"), F.sort_array(F.collect_list("entry")).alias("__entries")
    )
    vectors = F.transform("__entries", lambda e: F.map_from_entries(e["elser"]))
    return _with_vectors(rows.select("__all.*", vectors.alias("__vectors")))


def _with_vectors(articles: DataFrame) -> DataFrame:
    """Put `__vectors`, one for each of `_texts`, where the vectors of an article belong."""

    def vector(at: Column, text: Column) -> Column:
        none = F.array().cast("array<struct<key:string,value:float>>")
        found = F.coalesce(F.get("__vectors", at), F.map_from_entries(none))
        return F.when(text.isNotNull(), found)

    chunks = F.transform(
        "embeddings.content_chunks",
        lambda c, i: F.struct(c["text"].alias("text"), vector(i + 2, c["text"]).alias("elser")),
    )
    fresh = F.struct(
        F.struct(vector(F.lit(0), F.col("title")).alias("elser")).alias("title"),
        F.struct(vector(F.lit(1), F.col("description")).alias("elser")).alias("description"),
        chunks.alias("content_chunks"),
    )
    return articles.withColumn("embeddings", fresh).drop("__vectors")


#: Articles of a block, by a power of two. Larger blocks move fewer words, smaller ones spread better.
BLOCK_BITS = 13


def _tfidf(articles: DataFrame) -> DataFrame:
    """Articles with `__vectors`: the weights of each of their texts.

    Articles are written once, in blocks of neighbours. A block's words are counted
    together and only they move, once each, to meet their frequencies and back; so
    does an article, to its block's words. A word that comes back is in several texts
    of the corpus, any other is in one.
    """
    spark = articles.sparkSession
    chunks = F.transform("embeddings.content_chunks", lambda c: F.struct(c["text"].alias("text")))
    path = scratch_dir(spark, "articles")
    placed = articles.withColumns({
        "embeddings": F.struct(chunks.alias("content_chunks")),  # stale vectors stay behind
        "__block": F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS),
        "__texts": F.size(F.filter(_texts(articles), lambda t: t.isNotNull())),
    })
    placed.write.option("compression", "zstd").parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    total = placed.agg(F.coalesce(F.sum("__texts"), F.lit(0))).first()[0]

    def idf(df: Column) -> Column:
        return F.log((F.lit(total) + 1) / (df + 1)) + 1

    def spaced(rows: DataFrame) -> Column:
        return F.transform(clean_texts(_texts(rows)), spaced_words)

    counts = placed.select("__block", spaced(placed).alias("__spaced")).mapInArrow(weights.count_words, weights.COUNTED)
    df = F.sum("n").over(W.partitionBy("token"))
    known = counts.select("block", "token", df.alias("df")).filter("df > 1").toDF("__block", "__token", "__df")

    both = placed.drop("__texts").unionByName(known, allowMissingColumns=True)
    both = both.repartition("__block").sortWithinPartitions("__block", F.col("__token").isNull())
    vectors = weights.weigh("__block", "__token", idf(F.col("__df")), spaced(both), idf(F.lit(1)))
    weighed = both.withColumn("__vectors", vectors).filter("__token is null")
    return weighed.drop("__block", "__token", "__df")


def _placed_runs(words: Column) -> Column:
    """`(token, n, first_pos)` of sorted `(token, pos)`."""
    last = F.filter(
        F.sequence(F.lit(1), F.size(words)),
        lambda i: (i == F.size(words)) | (F.get(words, i)["token"] != F.get(words, i - 1)["token"]),
    )

    def entry(ends: Column) -> Column:
        def one(end: Column, k: Column) -> Column:
            start = F.when(k == 0, 0).otherwise(F.get(ends, k - 1))
            return let(
                F.get(words, start),
                lambda w: F.struct(w["token"].alias("token"), (end - start).cast("bigint").alias("n"), w["pos"].alias("first_pos")),
            )

        return F.transform(ends, one)

    return let(last, entry)


def without_vectors(articles: DataFrame) -> DataFrame:
    """Drop every stored vector, at the top level and inside each chunk."""
    bare = F.transform(
        F.col("embeddings.content_chunks"), lambda c: c.dropFields("elser")
    )
    return articles.withColumn(
        "embeddings",
        F.col("embeddings")
        .dropFields("title.elser", "description.elser")
        .withField("content_chunks", bare),
    )
