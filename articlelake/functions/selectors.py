"""Per-site selector rules.

A rule made of one tag with classes, an id or attributes becomes a pair of
patterns that Spark applies to the whole page. Rules with parents or a list of
alternatives, and pages where an element holds another of its own kind, are
answered from the page's tree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tree as T
from .binding import let
from .html import TAG_REST
from .tree import VOID_TAGS

_PART = r"""#[\w-]+|\.[\w-]+|\[\s*[\w:-]+\s*(?:[\^*$~]?=\s*(?:"[^"]*"|'[^']*'|[^"'\]]*)\s*)?\]"""
_COMPOUND = rf"^(?=.)(?:[A-Za-z][\w-]*|\*)?(?:{_PART})*$"
_SKIP = r"""(?:[^>"']*(?:"[^"]*"|'[^']*'))*?[^>"']*?"""
# Outside the brackets of an attribute test.
_PLAIN = r"(?![^\[]*\])"


def _quoted(text: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _extract(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract(text, pattern, group)


def _value(test: Column, value: Column) -> Column:
    """Pattern of an attribute's value as it stands in a tag."""

    def form(any_: str, quote: str) -> Column:
        some, none = F.lit(any_), F.lit("")
        before = F.when(test.isin("$=", "*="), some).when(test == "~=", rf"(?:{any_}\s)?").otherwise(none)
        after = F.when(test.isin("^=", "*="), some).when(test == "~=", rf"(?:\s{any_})?").otherwise(none)
        return F.concat(F.lit(quote), before, _quoted(value), after, F.lit(quote))

    bare = F.concat(form(r"[^\s>]*", ""), F.lit(r"(?=[\s/>])"))
    return F.concat(F.lit("(?:"), F.concat_ws("|", form('[^"]*', '"'), form("[^']*", "'"), bare), F.lit(")"))


def _look(part: Column) -> Column:
    """Look-ahead for one class, id or attribute test."""
    named = part.startswith("[")
    name = F.when(part.startswith("#"), "id").when(part.startswith("."), "class").otherwise(_extract(part, r"^\[\s*([\w:-]+)", 1))
    own = F.when(part.startswith("#"), "=").otherwise("~=")
    test = F.when(named, _extract(part, r"^\[\s*[\w:-]+\s*([\^*$~]?=)", 1)).otherwise(own)
    given = F.regexp_replace(_extract(part, r"(?s)=\s*(.*?)\s*\]$", 1), r"""^["']|["']$""", "")
    value = F.when(named, given).otherwise(F.substring(part, F.lit(2), F.length(part)))
    tail = F.when(test == "", F.lit(r"(?=[\s=/>])")).otherwise(F.concat(F.lit(r"\s*=\s*"), _value(test, value)))
    return F.concat(F.lit(rf"(?={_SKIP}\s(?i:"), _quoted(name), F.lit(")"), tail, F.lit(")"))


def _open(compound: Column) -> Column:
    """Pattern of the open tag of `tag.class[attr=value]`."""
    tag = _extract(compound, r"^[A-Za-z][\w-]*")
    name = F.when(tag == "", F.lit("[A-Za-z][A-Za-z0-9-]*")).otherwise(F.concat(F.lit("(?i:"), _quoted(tag), F.lit(")")))
    looks = F.array_join(F.transform(F.regexp_extract_all(compound, F.lit(f"({_PART})"), F.lit(1)), _look), "")
    return F.concat(F.lit("(?s)<("), name, F.lit(r")(?=[\s/>])"), looks, F.lit(f"{TAG_REST}>"))


def _path(text: Column) -> Column:
    """Steps of one alternative: `array<struct<child, compound>>`."""
    marked = F.regexp_replace(F.trim(text), rf"\s*>\s*{_PLAIN}", " >")
    return F.transform(
        F.split(marked, rf"\s+{_PLAIN}"),
        lambda s: F.struct(s.startswith(">").alias("child"), F.regexp_replace(s, "^>", "").alias("compound")),
    )


def compile_rule(css: Column) -> Column:
    """Patterns of one selector as a struct; all null for an empty one.

    `open` and `whole` are set for a rule of one step; `paths` holds the steps of every
    alternative. `error` names a selector that is not supported.
    """

    def compiled(paths: Column) -> Column:
        good = F.forall(paths, lambda p: F.forall(p, lambda s: s["compound"].rlike(_COMPOUND)) & ~F.get(p, 0)["child"])
        steps = F.transform(
            paths, lambda p: F.transform(p, lambda s: F.struct(s["child"].alias("child"), _open(s["compound"]).alias("open")))
        )
        void = F.lower(_extract(F.get(F.get(paths, 0), 0)["compound"], r"^[A-Za-z][\w-]*")).isin(*VOID_TAGS)
        rest = F.when(void, F.lit("")).otherwise(F.lit(r".*?</(?i:\1)\s*>"))

        def rule(steps: Column) -> Column:
            single = (F.size(steps) == 1) & (F.size(F.get(steps, 0)) == 1)
            start = F.when(single, F.get(F.get(steps, 0), 0)["open"])
            complaint = F.when(steps.isNull(), F.concat(F.lit("unsupported selector: "), css))
            return F.struct(
                css.alias("css"), start.alias("open"), F.concat(start, rest).alias("whole"), steps.alias("paths"),
                complaint.alias("error"),
            )

        return let(F.when(good, steps), rule)

    given = F.trim(css) != ""
    paths = F.transform(F.split(css, rf",{_PLAIN}"), _path)
    return F.when(given, let(paths, compiled))


def compile_rules(lists: Column) -> Column:
    """`compile_rule` for a column of lists; empty selectors are left out."""
    return F.array_compact(F.transform(lists, compile_rule))


# --------------------------------------------------------- patterns over whole pages


def first_open(html: Column, rule: Column) -> Column:
    """Open tag of the first match, or an empty string."""
    return F.call_function("regexp_extract", html, rule["open"], F.lit(0))


def first_whole(html: Column, rule: Column) -> Column:
    return F.call_function("regexp_extract", html, rule["whole"], F.lit(0))


def all_whole(html: Column, rule: Column) -> Column:
    return F.regexp_extract_all(html, rule["whole"], F.lit(0))


def holds_own_kind(outer: Column) -> Column:
    """Whether an element found by pattern has a same-named tag inside it."""
    name = F.regexp_extract(outer, r"^<([A-Za-z][A-Za-z0-9-]*)", 1)
    again = F.concat(F.lit(r"(?is)^<.+<\Q"), name, F.lit(r"\E(?=[\s/>])"))
    return (outer != "") & F.call_function("regexp_like", outer, again)


# ------------------------------------------------------------------ from the tree


def first_match(tree: Column, rule: Column) -> Column:
    """First match of a selector as outer HTML; null when there is none."""
    first = F.get(T.matches(tree, rule["paths"]), F.lit(0))
    return F.when(rule["paths"].isNotNull(), let(first, lambda e: F.when(e.isNotNull(), T.outer_html(tree, e))))


def removed_elements(tree: Column, rules: Column) -> Column:
    """Outermost elements that the rules remove."""
    return T.outermost(F.sort_array(F.flatten(F.transform(rules, lambda r: T.matches(tree, r["paths"])))))


def outer_without(tree: Column, found: Column, holes: Column) -> Column:
    """Outer HTML of elements, without `holes` and what is in them."""
    kept = T.enclosed(found, holes, own=True, outside=True)
    return F.transform(kept, lambda e: T.outer_html(tree, e, holes))


def link_tags(tree: Column, lists: Column, boxes: Column, links: Column) -> Column:
    """Open tags of the link elements of a front page; null when the configured list is missing.

    Lists, boxes and links are matches in the tree, null where no selector is configured.
    """
    page = F.struct(
        F.lit(-1).alias("at"), F.size(tree["pieces"]).alias("until"), F.lit(0).alias("level"), F.lit("").alias("tag")
    )
    scope = F.when(lists.isNull(), page).otherwise(F.get(lists, F.lit(0)))
    none = F.filter(tree["elements"], lambda e: F.lit(False))
    found = T.enclosed(F.coalesce(boxes, none), F.array(scope))
    chosen = let(found, lambda f: F.when(links.isNull(), f).otherwise(T.first_inside(f, links)))
    return F.when(scope.isNotNull(), F.transform(chosen, lambda e: e["tag"]))
