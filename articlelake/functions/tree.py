"""Elements of a page with their extent and depth, by built-in expressions.

A page is cut into pieces, alternately text and tag. Elements are ranges of
pieces. Their ends come from running sums: among the tags of one name, an open
tag and the next close tag of the same level belong together. Sorting and running
sums are the only steps, so a page of any nesting, or of tags that are never
closed, costs n log n.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .html import TAG_REST

# Tags that never have content.
VOID_TAGS = tuple("area base br col embed hr img input link meta param source track wbr".split())

_CHUNK = 128
_TAG = rf"</?[A-Za-z]{TAG_REST}>"


def _none() -> Column:
    return F.lit(None).cast("int")


def running(values: Column, zero: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Every value combined with all before it; `zero` changes nothing, order of grouping neither.

    An appended array is copied, so values are run through in short chunks and
    what each chunk comes to is carried over.
    """
    kind = F.array_repeat(zero, 0)

    def run(part: Column) -> Column:
        last = lambda done: F.coalesce(F.try_element_at(done, F.lit(-1)), zero)
        return F.aggregate(part, kind, lambda done, x: F.array_append(done, combine(last(done), x)))

    def carried(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.element_at(c, -1))
        before = F.concat(F.array(zero), run(totals))
        joined = F.zip_with(chunks, F.slice(before, 1, F.size(chunks)), lambda c, b: F.transform(c, lambda x: combine(b, x)))
        return F.flatten(joined)

    def chunked(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(v), F.lit(_CHUNK))
        return let(F.transform(starts, lambda at: run(F.slice(v, at, _CHUNK))), carried)

    return let(values, lambda v: F.when(F.size(v) == 0, v).otherwise(chunked(v)))


def running_sum(values: Column) -> Column:
    return running(values, F.lit(0), lambda a, b: a + b)


def _last(values: Column) -> Column:
    """The last value that is not null, at every place."""
    return running(values, _none(), lambda a, b: F.coalesce(b, a))


def page_tree(html: Column) -> Column:
    """`struct<pieces, elements: array<struct<at, until, level, tag>>>`, elements in page order.

    `at` and `until` are the first and last piece of an element. It ends at the close
    tag of its own name that balances it. One without such a tag reaches to the end of
    the closed element around it, so what follows it there lies in it. Close tags without an
    open one are left out.
    """
    pieces = F.split(F.regexp_replace(html, _TAG, "\u0001$0\u0001"), "\u0001")
    return let(pieces, lambda p: F.struct(p.alias("pieces"), _elements(p).alias("elements")))


def _elements(pieces: Column) -> Column:
    def tag(at: Column) -> Column:
        text = F.get(pieces, at)
        name = F.lower(F.regexp_extract(text, r"^</?([A-Za-z][^\s/>]*)", 1))
        empty = text.endswith("/>") | name.isin(*VOID_TAGS)
        kind = F.when(text.startswith("</"), -1).when(empty, 0).otherwise(1)
        return F.struct(name.alias("name"), at.alias("at"), kind.alias("kind"))

    odd = F.when(F.size(pieces) > 2, F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)))
    tags = F.coalesce(F.transform(odd, tag), F.array().cast("array<struct<name:string,at:int,kind:int>>"))
    return let(F.sort_array(tags), lambda t: _placed(pieces, _closed(t)))


def _closed(tags: Column) -> Column:
    """`(at, until)` of open tags sorted by name and place; `until` is null without a close tag, `at` for empty ones."""
    depth = running_sum(F.transform(tags, lambda t: t["kind"]))
    levelled = F.zip_with(
        tags,
        depth,
        lambda t, d: F.struct(
            t["name"].alias("name"), (d + F.when(t["kind"] < 0, 1).otherwise(0)).alias("level"),
            t["at"].alias("at"), t["kind"].alias("kind"),
        ),
    )
    moving = F.sort_array(F.filter(levelled, lambda t: t["kind"] != 0))

    def paired(events: Column) -> Column:
        def until(t: Column, i: Column) -> Column:
            after = F.get(events, i + 1)
            own = (after["name"] == t["name"]) & (after["level"] == t["level"]) & (after["kind"] < 0)
            return F.struct(t["at"].alias("at"), F.when(own, after["at"]).alias("until"), t["kind"].alias("kind"))

        return F.filter(F.transform(events, until), lambda t: t["kind"] > 0)

    empty = F.transform(
        F.filter(tags, lambda t: t["kind"] == 0), lambda t: F.struct(t["at"].alias("at"), t["at"].alias("until"), F.lit(0).alias("kind"))
    )
    return F.concat(let(moving, paired), empty)


def _placed(pieces: Column, opened: Column) -> Column:
    """Ends of unclosed elements, from the nest of the closed ones; then all levels."""

    def events(e: Column) -> Column:
        def event(at: Column, step: int, until: Column) -> Column:
            return F.struct(at.alias("at"), F.lit(step).alias("step"), until.alias("until"))

        pair = F.array(event(e["at"], 1, e["until"]), event(e["until"], -1, _none()))
        point = F.array(event(e["at"], 0, F.when(e["kind"] == 0, e["until"])))
        return F.when((e["kind"] > 0) & e["until"].isNotNull(), pair).otherwise(point)

    ordered = F.sort_array(F.flatten(F.transform(opened, events)))

    def levelled(all_: Column) -> Column:
        depth = running_sum(F.transform(all_, lambda e: e["step"]))
        lined = F.zip_with(
            all_,
            depth,
            lambda e, d: F.struct(d.alias("level"), e["at"].alias("at"), e["step"].alias("step"), e["until"].alias("until")),
        )
        return F.sort_array(F.filter(lined, lambda e: e["step"] >= 0))

    def ended(lined: Column) -> Column:
        around = _last(F.transform(lined, lambda e: F.when(e["step"] > 0, e["until"])))

        def element(e: Column, close: Column) -> Column:
            until = F.coalesce(e["until"], F.when(e["level"] > 0, close) - 1, F.size(pieces) - 1)
            return F.struct(e["at"].alias("at"), until.alias("until"))

        return F.sort_array(F.zip_with(lined, around, element))

    return let(let(let(ordered, levelled), ended), lambda ranges: _nested(pieces, ranges))


def _nested(pieces: Column, ranges: Column) -> Column:
    """Elements of ranges in page order, with how many they lie in, themselves included."""

    def edges(e: Column) -> Column:
        def edge(at: Column, order: int, step: int) -> Column:
            return F.struct(at.alias("at"), F.lit(order).alias("order"), F.lit(step).alias("step"))

        return F.array(edge(e["at"], 0, 1), edge(e["until"], 1, -1))

    def levels(marks: Column) -> Column:
        depth = running_sum(F.transform(marks, lambda m: m["step"]))
        return F.array_compact(F.zip_with(marks, depth, lambda m, d: F.when(m["step"] > 0, d)))

    depth = let(F.sort_array(F.flatten(F.transform(ranges, edges))), levels)
    return F.zip_with(
        ranges,
        depth,
        lambda e, d: F.struct(
            e["at"].alias("at"), e["until"].alias("until"), d.alias("level"), F.get(pieces, e["at"]).alias("tag")
        ),
    )


# -------------------------------------------------------------- sets of elements


def _is(element: Column, opened: Column) -> Column:
    return F.call_function("regexp_extract", element["tag"], F.concat(F.lit("^"), opened), F.lit(0)) != ""


def enclosed(inner: Column, outer: Column, child: Column | None = None, own: bool = False, outside: bool = False) -> Column:
    """Elements of `inner` that lie in one of `outer`, as its children where `child` is true.

    With `own`, an element lies in itself; with `outside`, all others are taken.
    """
    child = F.lit(False) if child is None else child

    def mark(level: Column, at: Column, order: int, step: int, nth: Column) -> Column:
        key = F.when(child, level).otherwise(0)
        return F.struct(
            key.alias("level"), at.alias("at"), F.lit(order).alias("order"), F.lit(step).alias("step"), nth.alias("nth")
        )

    nowhere = F.lit(-1)
    edges = F.flatten(
        F.transform(
            outer, lambda e: F.array(mark(e["level"] + 1, e["at"], 1, 1, nowhere), mark(e["level"] + 1, e["until"], 3, -1, nowhere))
        )
    )
    points = F.transform(inner, lambda e, i: mark(e["level"], e["at"], 2 if own else 0, 0, i))

    def hits(marks: Column) -> Column:
        depth = running_sum(F.transform(marks, lambda m: m["step"]))
        taken = (lambda d: d == 0) if outside else (lambda d: d > 0)
        each = F.zip_with(marks, depth, lambda m, d: F.when((m["nth"] >= 0) & taken(d), m["nth"]))
        return F.sort_array(F.array_compact(each))

    return F.transform(let(F.sort_array(F.concat(edges, points)), hits), lambda i: F.get(inner, i))


def matches(tree: Column, paths: Column) -> Column:
    """Elements that one of the rule's paths leads to, in page order."""
    elements = tree["elements"]

    def along(path: Column) -> Column:
        first = F.filter(elements, lambda e: _is(e, F.get(path, 0)["open"]))
        rest = F.slice(path, 2, F.greatest(F.size(path) - 1, F.lit(0)))
        return F.aggregate(
            rest,
            first,
            lambda scope, step: let(
                F.filter(elements, lambda e: _is(e, step["open"])), lambda found: enclosed(found, scope, step["child"])
            ),
        )

    def once(found: Column) -> Column:
        return F.filter(found, lambda e, i: (i == 0) | (F.get(found, i - 1)["at"] != e["at"]))

    return let(F.sort_array(F.flatten(F.transform(paths, along))), once)


def outermost(found: Column) -> Column:
    """Elements, in page order, that lie in no other one of them."""

    def kept(all_: Column) -> Column:
        reach = running(F.transform(all_, lambda e: e["until"]), F.lit(-1), lambda a, b: F.greatest(a, b))
        return let(reach, lambda r: F.filter(all_, lambda e, i: (i == 0) | (F.get(r, i - 1) < e["at"])))

    return let(found, kept)


def outer_html(tree: Column, element: Column, holes: Column | None = None) -> Column:
    """An element's pieces, without those of outermost `holes` in it."""

    def between(first: Column, last: Column) -> Column:
        return F.array_join(F.slice(tree["pieces"], first + 1, F.greatest(last - first + 1, F.lit(0))), "")

    whole = between(element["at"], element["until"])
    if holes is None:
        return whole

    def cut(inside: Column) -> Column:
        def stretch(i: Column) -> Column:
            first = F.when(i == 0, element["at"]).otherwise(F.get(inside, i - 1)["until"] + 1)
            last = F.when(i == F.size(inside), element["until"]).otherwise(F.get(inside, i)["at"] - 1)
            return between(first, last)

        pieces = F.transform(F.sequence(F.lit(0), F.size(inside)), stretch)
        return F.when(F.size(inside) == 0, whole).otherwise(F.array_join(pieces, ""))

    within = F.filter(holes, lambda h: (h["at"] > element["at"]) & (h["until"] <= element["until"]))
    return let(within, cut)


def first_inside(boxes: Column, wanted: Column) -> Column:
    """The first of `wanted` inside each box that has one, in the order of the boxes."""
    of_box = F.transform(boxes, lambda b, i: F.struct(b["at"].alias("at"), F.lit(1).alias("box"), i.alias("nth")))
    of_wanted = F.transform(wanted, lambda w, i: F.struct(w["at"].alias("at"), F.lit(0).alias("box"), i.alias("nth")))

    def followed(marks: Column) -> Column:
        # From the end of the page, the wanted element passed last is the next one.
        after = _last(F.transform(marks, lambda m: F.when(m["box"] == 0, m["nth"])))
        each = F.zip_with(marks, after, lambda m, w: F.struct(m["nth"].alias("nth"), m["box"].alias("box"), F.get(wanted, w).alias("w")))
        inside = F.filter(each, lambda m: (m["box"] == 1) & (m["w"]["until"] <= F.get(boxes, m["nth"])["until"]))
        return F.transform(F.sort_array(inside), lambda m: m["w"])

    return let(F.sort_array(F.concat(of_box, of_wanted), asc=False), followed)
