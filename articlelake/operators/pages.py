"""Page parsing as jobs over a table of pages.

Every result is computed inside the page's own row: apart from the join with
the site rules nothing here moves pages between partitions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import selectors as S
from ..functions import tree as T
from ..functions.binding import built_once, computed_once
from ..functions.dates import publish_date
from ..functions.urls import resolve_url, site_icon, url_host
from ..session import broadcast_if_bounded, fits_broadcast

# Long expressions over columns that always have the same name.
_tree = built_once(lambda page: T.page_tree(F.col(page)))
_matches = built_once(lambda tree, rule: T.matches(F.col(tree), F.col(rule)["paths"]))
_first_match = built_once(lambda tree, rule: S.first_match(F.col(tree), F.col(rule)))
_link_tags = built_once(lambda tree, *found: S.link_tags(F.col(tree), *map(F.col, found)))
_removed = built_once(lambda tree, rules: S.removed_elements(F.col(tree), F.col(rules)))
_outer_without = built_once(lambda tree, found, holes: S.outer_without(F.col(tree), F.col(found), F.col(holes)))
_rule = built_once(lambda css: S.compile_rule(F.col(css)))
_decoded = built_once(lambda texts: F.transform(texts, H.decode_entities))
_blocks = built_once(lambda page: H.text_blocks(F.col(page)))

META_FIELDS = ("title", "description", "image_url", "author", "publish_date")


def split_by_status(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages fetched with status 200, and the rest with a reason."""
    if "status" not in pages.columns:
        return pages, pages.limit(0).withColumn("reason", F.lit(""))
    fine = F.col("status").eqNullSafe(200)
    code = F.coalesce(F.col("status").cast("string"), F.lit("missing"))
    rejected = pages.filter(~fine).withColumn("reason", F.concat(F.lit("status "), code))
    return pages.filter(fine), rejected


def compile_profiles(profiles: DataFrame) -> DataFrame:
    """One row per profile with its selectors turned into patterns.

    This runs on the small rule table, a row per selector; pages only see the finished patterns.
    """
    meta = F.col("scraping.meta")
    removed = F.col("scraping.content.remove")
    slots = {
        "list": F.col("source.scraping_targets.container_list"),
        "box": F.col("source.scraping_targets.link_containers"),
        "link": F.col("source.scraping_targets.links"),
        "content": F.col("scraping.content.container"),
        **{f: meta[f]["element"] for f in META_FIELDS},
    }
    named = F.array(*[F.struct(F.lit(k).alias("slot"), css.alias("css")) for k, css in slots.items()])
    more = F.transform(
        F.coalesce(removed, F.array().cast("array<string>")), lambda r: F.struct(F.lit("remove").alias("slot"), r.alias("css"))
    )
    base = profiles.select(
        F.col("source.profile_name").alias("profile"),
        F.col("source.name").alias("site_name"),
        F.col("source.address").alias("address"),
        *[
            F.nullif(meta[f]["content_field"], F.lit("")).alias(f"{f}_attr")
            for f in META_FIELDS
        ],
        F.inline(F.concat(named, more)),
    )
    kept = [c for c in base.columns if c not in ("slot", "css")]
    compiled = base.withColumn("rule", _rule("css"))
    each = compiled.groupBy(*kept).agg(F.collect_list(F.struct("slot", "rule")).alias("rules"))

    def of(slot: str) -> Column:
        return F.transform(F.filter("rules", lambda r: r["slot"] == slot), lambda r: r["rule"])

    ruled = each.select(*kept, *[F.get(of(k), F.lit(0)).alias(f"{k}_rule") for k in slots], of("remove").alias("remove_rules"))
    return ruled.withColumn("remove_rules", F.array_compact("remove_rules"))


def _unsupported(*rules: str, removed: bool = False) -> Column:
    """Complaints about selectors that cannot be applied: their pages are rejected."""
    own = F.array_compact(F.array(*[F.col(f"{r}_rule")["error"] for r in rules]))
    if not removed:
        return own
    more = F.array_compact(F.transform("remove_rules", lambda r: r["error"]))
    return F.concat(own, more)


def with_profile(pages: DataFrame, profiles: DataFrame) -> DataFrame:
    """Name the profile of each page by the host of its address; null where no profile has it."""
    hosts = profiles.select(
        F.col("source.profile_name").alias("profile"),
        url_host(F.col("source.address")).alias("__host"),
    )
    return (
        pages.withColumn("__host", url_host(F.col("url")))
        .join(broadcast_if_bounded(hosts), "__host", "left")
        .drop("__host")
    )


def without_rules(pages: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pages whose `profile` is null or not among the profiles, which `with_rules` leaves out."""
    known = profiles.select(F.col("source.profile_name").alias("profile")).distinct()
    return pages.join(broadcast_if_bounded(known), "profile", "left_anti")


def with_rules(pages: DataFrame, profiles: DataFrame) -> DataFrame:
    """Attach the compiled rules of each page's `profile`, and the cleaned page."""
    rules = compile_profiles(profiles)
    # Patterns can be many times as long as the selectors, so the patterns are measured.
    if fits_broadcast(rules, max_rows=20_000, max_bytes=64 * 1024 * 1024):
        rules = F.broadcast(rules)
    joined = pages.join(rules, "profile")
    return joined.withColumn("__clean", H.strip_noise(F.col("html")))


def _set(rule: str) -> Column:
    return F.col(rule)["css"].isNotNull()


def _complex(rule: str) -> Column:
    return _set(rule) & F.col(rule)["open"].isNull()


# --------------------------------------------------------------------------- links


def extract_links(
    pages: DataFrame, profiles: DataFrame, max_per_page: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Article addresses on front pages as distinct `(profile, url)`, and rejects.

    The cap counts link elements before their address is looked at. A page
    whose configured list is missing rejects its whole profile, as does one
    whose profile is not known.
    """
    found = page_links(pages, profiles, max_per_page)
    unknown = without_rules(pages, profiles).select("profile", F.lit("no profile").alias("reason"))
    failed = (
        found.filter("reason is not null")
        .select("profile", "reason")
        .unionByName(unknown)
        .distinct()
    )
    links = (
        found.select("profile", F.explode_outer("links").alias("url"))
        .filter("url is not null")
        .distinct()
        .join(failed.select("profile"), "profile", "left_anti")
    )
    return links, failed


def page_links(
    pages: DataFrame, profiles: DataFrame, max_per_page: int = 10
) -> DataFrame:
    """Per page: the capped, resolved `links`, whether the list was missing, and why there are none."""
    ruled = with_rules(pages, profiles)
    clean = F.col("__clean")
    scope = F.when(
        _set("list_rule"), S.first_whole(clean, F.col("list_rule"))
    ).otherwise(clean)
    boxed = ruled.withColumn("__scope", scope).withColumn(
        "__inner",
        F.when(_set("list_rule"), H.inner_html(F.col("__scope"))).otherwise(
            F.col("__scope")
        ),
    )
    boxed = boxed.withColumn(
        "__boxes",
        F.when(
            _set("box_rule"), S.all_whole(F.col("__inner"), F.col("box_rule"))
        ).otherwise(F.array().cast("array<string>")),
    )
    # Boxes only lend their open tag when no inner link is configured.
    opened = F.regexp_count(F.col("__inner"), F.col("box_rule")["open"])
    needs_tree = (
        _complex("list_rule")
        | _complex("box_rule")
        | _complex("link_rule")
        | (_set("list_rule") & (F.col("__scope") == "") & _has_open("list_rule"))
        | S.holds_own_kind(F.when(_set("list_rule"), F.col("__scope")).otherwise(F.lit("")))
        | F.exists("__boxes", S.holds_own_kind)
        | (_set("box_rule") & (opened != F.size("__boxes")))
    )
    gate = F.coalesce(needs_tree, F.lit(False))
    boxed = boxed.withColumn("__gate", gate).withColumn("__tree", computed_once(F.when(gate, _tree("__clean"))))
    boxed = boxed.withColumns(
        {f"__{r}s": _matches("__tree", f"{r}_rule") for r in ("list", "box", "link")}
    )
    tags = _link_tags("__tree", "__lists", "__boxs", "__links")
    boxed = boxed.withColumn("__read", computed_once(F.when(F.col("__gate"), tags)))
    by_pattern = F.when(
        _set("link_rule"),
        F.filter(
            F.transform(
                F.col("__boxes"),
                lambda b: S.first_open(H.inner_html(b), F.col("link_rule")),
            ),
            lambda e: e != "",
        ),
    ).otherwise(F.col("__boxes"))
    missing = (
        F.when(F.col("__gate"), F.col("__read").isNull())
        .when(_set("list_rule"), F.col("__scope") == "")
        .otherwise(F.lit(False))
    )
    elements = F.when(F.col("__gate"), F.col("__read")).otherwise(by_pattern)
    hrefs = F.filter(
        F.transform(
            F.slice(elements, 1, max_per_page),
            lambda e: H.raw_attribute(e, F.lit("href")),
        ),
        lambda h: h.isNotNull(),
    )
    boxed = boxed.withColumn("__hrefs", hrefs)
    links = F.transform(_decoded("__hrefs"), lambda h: resolve_url(F.col("address"), h))
    bad = _unsupported("list", "box", "link")
    reason = F.when(F.size(bad) > 0, F.array_join(bad, "; ")).when(missing, "link list not found")
    return boxed.select(
        *pages.columns,
        missing.alias("list_missing"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.array().cast("array<string>")).otherwise(links).alias("links"),
    )


def _has_open(rule: str) -> Column:
    return S.first_open(F.col("__clean"), F.col(rule)) != ""


# ---------------------------------------------------------------------------- meta


def with_meta(ruled: DataFrame, as_of: Column, fall_through: bool = False) -> DataFrame:
    """Add `meta` (five fields), the date's origin and `errors` to ruled pages."""
    clean = F.col("__clean")
    found = ruled
    for f in META_FIELDS:
        rule, by_attr = F.col(f"{f}_rule"), F.col(f"{f}_attr").isNotNull()
        element = F.when(by_attr, S.first_open(clean, rule)).otherwise(
            S.first_whole(clean, rule)
        )
        found = found.withColumn(f"__{f}", element)
    doubtful = F.lit(False)
    for f in META_FIELDS:
        rule, whole = F.col(f"{f}_rule"), F.col(f"__{f}")
        by_text = _set(f"{f}_rule") & F.col(f"{f}_attr").isNull()
        unclosed = (whole == "") & (S.first_open(clean, rule) != "")
        doubtful |= _complex(f"{f}_rule") | (
            by_text & (unclosed | S.holds_own_kind(whole))
        )
    found = found.withColumn("__doubt", F.coalesce(doubtful, F.lit(False)))
    found = found.withColumn("__tree", computed_once(F.when(F.col("__doubt"), _tree("__clean"))))
    first = F.array(*[_first_match("__tree", f"{f}_rule") for f in META_FIELDS])
    found = found.withColumn("__read", computed_once(F.when(F.col("__doubt"), first)))

    def raw(f: str) -> Column:
        read = F.coalesce(F.get("__read", F.lit(META_FIELDS.index(f))), F.lit(""))
        element = F.when(F.col("__doubt"), read).otherwise(F.col(f"__{f}"))
        taken = F.when(
            F.col(f"{f}_attr").isNotNull(),
            H.raw_attribute(element, F.col(f"{f}_attr")),
        ).otherwise(H.strip_tags(element))
        return F.when(_set(f"{f}_rule"), F.nullif(taken, F.lit("")))

    found = found.withColumn("__raw", F.array(*[raw(f) for f in META_FIELDS]))
    found = found.withColumn("__values", _decoded("__raw"))
    found = found.withColumns(
        {f"__v_{f}": F.get("__values", F.lit(i)) for i, f in enumerate(META_FIELDS)}
    ).withColumn(
        "__ld",
        F.when(
            F.col("__v_author").isNull()
            | F.col("__v_publish_date").isNull()
            | F.lit(fall_through),
            H.json_ld_scripts(F.col("html")),
        ),
    )
    dated = publish_date(
        F.col("__v_publish_date"),
        H.json_ld_published(F.col("__ld")),
        as_of,
        fall_through=fall_through,
    )
    author = F.coalesce(F.col("__v_author"), H.json_ld_author(F.col("__ld")))
    icon = site_icon(F.col("address"))
    found = found.withColumn("__date", dated)
    meta = F.struct(
        F.col("__v_title").alias("title"),
        F.col("__v_description").alias("description"),
        F.coalesce(F.col("__v_image_url"), icon).alias("image_url"),
        F.regexp_replace(author, r"(?U)^\s++|(?<!\s)\s++$", "").alias("author"),
        F.col("__date")["value"].alias("publish_date"),
        F.col("__date")["origin"].alias("date_origin"),
    )
    missing = F.array_compact(
        F.array(
            *[
                F.when(F.col(f"__v_{f}").isNull(), F.lit(f"{f} not found"))
                for f in ("title", "description")
            ]
        )
    )
    errors = F.concat(missing, _unsupported(*META_FIELDS, "content", removed=True))
    spent = [c for c in found.columns if c.startswith("__") and c not in ruled.columns]
    return found.withColumns({"meta": meta, "errors": errors}).drop(*spent)


def extract_meta(
    pages: DataFrame, profiles: DataFrame, as_of: Column, fall_through: bool = False
) -> DataFrame:
    """Pages with `meta` and `errors`; a page with errors is a reject."""
    ruled = with_meta(with_rules(pages, profiles), as_of, fall_through)
    return ruled.select(*pages.columns, "meta.*", "errors")


# ------------------------------------------------------------------------- content


def with_containers(ruled: DataFrame) -> DataFrame:
    """Add `containers`: the HTML of every content element, removals applied."""
    clean, rule = F.col("__clean"), F.col("content_rule")

    def removable(removal: Column) -> Column:
        hits = S.all_whole(clean, removal)
        opened = F.regexp_count(clean, removal["open"])
        nested = F.exists(hits, S.holds_own_kind)
        return removal["open"].isNotNull() & ~nested & (opened == F.size(hits))

    cut = F.aggregate(
        F.col("remove_rules"),
        clean,
        lambda page, removal: F.call_function(
            "regexp_replace", page, removal["whole"], F.lit("")
        ),
    )
    found = ruled.withColumn(
        "__plain", F.coalesce(F.forall("remove_rules", removable), F.lit(False))
    ).withColumn("__cut", F.when(F.col("__plain") & ~_complex("content_rule"), cut))
    found = found.withColumn("__hits", S.all_whole(F.col("__cut"), rule))
    sound = (
        F.col("__cut").isNotNull()
        & ~F.exists("__hits", S.holds_own_kind)
        & (F.regexp_count(F.col("__cut"), rule["open"]) == F.size("__hits"))
    )
    found = found.withColumn(
        "__gate", _set("content_rule") & ~F.coalesce(sound, F.lit(False))
    ).withColumn("__tree", computed_once(F.when(F.col("__gate"), _tree("__clean"))))
    found = found.withColumns(
        {
            "__holes": _removed("__tree", "remove_rules"),
            "__found": _matches("__tree", "content_rule"),
        }
    )
    read = _outer_without("__tree", "__found", "__holes")
    found = found.withColumn("__read", computed_once(F.when(F.col("__gate"), read)))
    none = F.array().cast("array<string>")
    containers = F.when(F.col("__gate"), F.col("__read")).otherwise(
        F.coalesce(F.col("__hits"), none)
    )
    return found.withColumn("containers", containers).drop(
        "__plain", "__cut", "__hits", "__gate", "__tree", "__holes", "__found", "__read"
    )


def with_content(
    ruled: DataFrame,
    converters: Mapping[str, H.Converter] | None = None,
    inline: Mapping[str, H.InlineConverter] | None = None,
) -> DataFrame:
    """Add `blocks`, `content_html`, `content_text` and `markdown` to ruled pages."""
    found = with_containers(ruled).withColumn(
        "content_html",
        F.array_join(F.transform("containers", lambda c: F.concat(c, F.lit("\n"))), ""),
    )
    return found.withColumn("blocks", _blocks("content_html")).withColumns(
        {
            "content_text": _ended(H.blocks_text(F.col("blocks"))),
            "markdown": H.blocks_markdown(F.col("blocks"), converters, inline),
        }
    )


def _ended(text: Column) -> Column:
    return F.when(text == "", text).otherwise(F.concat(text, F.lit("\n")))


def extract_content(pages: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pages with their content as joined HTML and as plain text."""
    ruled = with_content(with_rules(pages, profiles))
    return ruled.select(*pages.columns, "content_html", "content_text")


def page_blocks(pages: DataFrame, profiles: DataFrame) -> DataFrame:
    """Block table: one row per text block of a page's content."""
    ruled = with_content(with_rules(pages, profiles))
    return (
        ruled.select("page_id", F.explode_outer("blocks").alias("block"))
        .filter("block is not null")
        .select("page_id", "block.pos", "block.tag", "block.text")
    )


def pages_to_markdown(
    pages: DataFrame,
    profiles: DataFrame,
    converters: Mapping[str, H.Converter] | None = None,
    inline: Mapping[str, H.InlineConverter] | None = None,
) -> DataFrame:
    """Pages with their content as Markdown; `converters` are by block tag, `inline` by inline tag."""
    ruled = with_content(with_rules(pages, profiles), converters, inline)
    return ruled.select(*pages.columns, "markdown")
