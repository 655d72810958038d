"""Reading HTML with built-in expressions: tags, attributes, text, blocks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

#: Rest of an open tag, quoted values included; possessive, so it never backtracks.
TAG_REST = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+"""

_NOISE = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script(?=[\s/>]).*?(?:</script\s*>|\z)"
    r"|<style(?=[\s/>]).*?(?:</style\s*>|\z)"
    r"|[\x01\x02]"
)
_JSON_LD = (
    r"(?is)<script(?=\s)[^>]*\stype\s*=\s*[\"']?application/ld\+json[\"']?[^>]*>"
    r"(.*?)</script\s*>"
)
_PERSON = r'(?s)"@type":"Person",.*?"name":"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
_PUBLISHED = r'(?s)"datePublished":"([^"\\]*+(?:\\.[^"\\]*+)*+)"'

# Tags that start a new block of text.
BLOCK_TAGS = (
    "address article aside blockquote body dd div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td "
    "th title tr ul"
).split()

_BLOCK_EDGE = rf"(?i)<(/?)({'|'.join(BLOCK_TAGS)})(?=[\s/>]){TAG_REST}>"
_BREAK = rf"(?i)<br(?=[\s/>]){TAG_REST}>"
_ANY_TAG = rf"</?[A-Za-z!?]{TAG_REST}>"

_HEAD = rf"^<[^>\s/]+(?=[\s/>]){TAG_REST}>"

_BASIC = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "#39": "'", "amp": "&"}
_BASIC_NAMES = "|".join(_BASIC)
_ENTITY = r"&(#[0-9]++|#[xX][0-9A-Fa-f]++|[A-Za-z][A-Za-z0-9]*+);"
# References to these control codes mean the characters of an old code page.
_OLD_CODES = {i: bytes([i]).decode("cp1252") for i in range(0x80, 0xA0) if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def strip_noise(html: Column) -> Column:
    """Page without comments, scripts and style sheets, found in one pass."""
    return F.regexp_replace(html, _NOISE, "")


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(html, _BREAK, "\n"), _ANY_TAG, "")


def decode_entities(text: Column) -> Column:
    """Character references resolved once: `&amp;lt;` gives `&lt;`."""
    return let(text, _decoded)


def _decoded(text: Column) -> Column:
    basic = text
    for name, char in _BASIC.items():
        basic = F.replace(basic, F.lit(f"&{name};"), F.lit(char))
    others = rf"&(?!(?:{_BASIC_NAMES});)(?:#|[A-Za-z])[A-Za-z0-9]*;"
    pieces = F.split(F.regexp_replace(text, _ENTITY, "\u0001&$1\u0001"), "\u0001")
    full = F.array_join(F.transform(pieces, _decoded_piece), "")
    return (
        F.when(~F.contains(text, F.lit("&")), text)
        .when(~text.rlike(others), basic)
        .otherwise(full)
    )


def _decoded_piece(piece: Column) -> Column:
    names = {n[:-1]: c for n, c in html5.items() if n.endswith(";")}
    listed = F.lit("\u0002".join(f"{n}\u0001{c}" for n, c in names.items()))
    table = F.str_to_map(listed, F.lit("\u0002"), F.lit("\u0001"))

    def char(code: Column) -> Column:
        usable = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        text = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        text = F.translate(text, "".join(map(chr, _OLD_CODES)), "".join(_OLD_CODES.values()))
        return F.when(usable, text).otherwise(F.lit("\ufffd"))

    def resolve(name: Column) -> Column:
        digits = F.regexp_replace(name, "^#[xX]?0*(?=.)", "")
        code = F.when(name.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
        # Longer than any code point: out of range.
        code = F.when(F.length(digits) > 8, "0").otherwise(code)
        known = F.coalesce(F.try_element_at(table, name), F.concat(piece, F.lit(";")))
        return F.when(name.startswith("#"), let(code.try_cast("bigint"), char)).otherwise(
            known
        )

    return F.when(
        piece.rlike("^&."), let(F.substring(piece, F.lit(2), F.length(piece)), resolve)
    ).otherwise(piece)


def inner_html(outer: Column) -> Column:
    """An element without its own open and close tag."""
    return F.regexp_replace(outer, rf"(?s){_HEAD}|</[^<>]*>\s*$", "")


def raw_attribute(element: Column, name: Column) -> Column:
    """Value of an attribute of the leading tag, undecoded; null when absent."""
    pattern = F.concat(
        F.lit(r"(?is)^<[^>\s/]+(?:[^>\"']*(?:\"[^\"]*\"|'[^']*'))*?[^>\"']*?\s\Q"),
        name,
        F.lit(r"""\E(\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?(?=[\s/>])"""),
    )

    def value(head: Column) -> Column:
        def group(n: int) -> Column:
            return F.call_function("regexp_extract", head, pattern, F.lit(n))

        return F.when(group(0) != "", F.concat(group(2), group(3), group(4)))

    return let(F.regexp_extract(element, rf"(?s){_HEAD}", 0), value)


# ---------------------------------------------------------------- structured data


def json_ld_scripts(html: Column) -> Column:
    """Compact JSON of every valid linked-data script, in page order."""
    scripts = F.regexp_extract_all(html, F.lit(_JSON_LD), F.lit(1))
    return F.filter(
        F.transform(scripts, lambda s: F.get_json_object(s, "$")),
        lambda s: s.isNotNull(),
    )


def _first_match(scripts: Column, pattern: str) -> Column:
    found = F.transform(scripts, lambda s: F.regexp_extract(s, pattern, 1))
    first = F.get(F.filter(found, lambda v: v != ""), F.lit(0))
    return F.get_json_object(F.concat(F.lit('{"v":"'), first, F.lit('"}')), "$.v")


def json_ld_author(scripts: Column) -> Column:
    """Name of the first person described."""
    return _first_match(scripts, _PERSON)


def json_ld_published(scripts: Column) -> Column:
    return _first_match(scripts, _PUBLISHED)


# ------------------------------------------------------------------------- blocks


def text_blocks(html: Column) -> Column:
    """Blocks of cleaned HTML in order: `array<struct<pos, tag, html, text>>`.

    The page is cut at the edges of block tags, so tags that are never closed
    do no harm. `tag` is the block's own tag, or empty for text after a close
    tag. Blocks without text are left out.
    """
    cut = F.split(F.regexp_replace(html, _BLOCK_EDGE, "\u0001$1$2\u0002"), "\u0001")

    def piece(text: Column) -> Column:
        tag = F.lower(F.substring_index(text, "\u0002", 1))
        own = F.contains(text, F.lit("\u0002")) & ~text.startswith("/")
        return F.struct(
            F.when(own, tag).otherwise(F.lit("")).alias("tag"),
            F.substring_index(text, "\u0002", -1).alias("html"),
        )

    def block(piece: Column) -> Column:
        return F.struct(
            piece["tag"].alias("tag"),
            piece["html"].alias("html"),
            _trim(decode_entities(strip_tags(piece["html"]))).alias("text"),
        )

    # One array function per step, so no step is evaluated twice.
    kept = F.filter(
        F.transform(F.transform(cut, piece), block), lambda b: b["text"] != ""
    )
    return F.transform(
        kept,
        lambda b, i: F.struct(
            i.alias("pos"),
            b["tag"].alias("tag"),
            b["html"].alias("html"),
            b["text"].alias("text"),
        ),
    )


def _trim(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s++|(?<!\s)\s++$", "")


def blocks_text(blocks: Column) -> Column:
    """Plain text of a page, one block per line."""
    return F.array_join(F.transform(blocks, lambda b: b["text"]), "\n")


# ----------------------------------------------------------------------- Markdown

Converter = Callable[[Column], Column]


def _prefixed(prefix: str) -> Converter:
    return lambda text: F.concat(F.lit(prefix), text)


def _fenced(text: Column) -> Column:
    return F.concat(F.lit("```\n"), text, F.lit("\n```"))


def default_converters() -> dict[str, Converter]:
    """Markdown of a block's text by tag; a copy, so a caller may override entries."""
    return {
        **{f"h{n}": _prefixed("#" * n + " ") for n in range(1, 7)},
        "li": _prefixed("- "),
        "blockquote": _prefixed("> "),
        "pre": _fenced,
    }


#: From the text and the open tag of an inline element to its Markdown.
InlineConverter = Callable[[Column, Column], Column]


def default_inline() -> dict[str, InlineConverter]:
    """Markdown of inline elements by tag, inner ones first; a copy, so a caller may override or add entries."""

    def around(mark: str) -> InlineConverter:
        return lambda text, tag: F.concat(F.lit(mark), F.trim(text), F.lit(mark))

    def link(text: Column, tag: Column) -> Column:
        href = raw_attribute(tag, F.lit("href"))
        return F.when(href.isNull(), text).otherwise(F.concat(F.lit("["), text, F.lit("]("), href, F.lit(")")))

    bold, slanted = around("**"), around("*")
    return {"b": bold, "strong": bold, "i": slanted, "em": slanted, "code": around("`"), "a": link}


def _converted_inline(html: Column, table: Mapping[str, InlineConverter]) -> Column:
    """Every closed element of the table's tags, in its order, replaced by what its converter makes of it.

    The text between elements is cut out and put back, so converters see whole elements.
    """
    for tag, convert in table.items():
        html = let(html, _element_replacer(tag, convert))
    return html


def _element_replacer(tag: str, convert: InlineConverter) -> Converter:
    element = rf"(?is)<{tag}(?=[\s/>]){TAG_REST}>.*?</{tag}\s*>"

    def one(e: Column) -> Column:
        return convert(inner_html(e), F.regexp_extract(e, rf"(?s){_HEAD}", 0))

    def replaced(text: Column) -> Column:
        found = F.transform(F.regexp_extract_all(text, F.lit(element), F.lit(0)), one)
        ends = F.concat(found, F.array(F.lit("")))
        return F.array_join(F.flatten(F.zip_with(F.split(text, element, -1), ends, lambda t, m: F.array(t, m))), "")

    return replaced


def _inline_markdown(html: Column) -> Column:
    def wrap(text: Column, tags: str, mark: str) -> Column:
        pair = rf"(?is)<({tags})(?=[\s/>]){TAG_REST}>\s*([^<]+?)\s*</\1\s*>"
        return F.regexp_replace(text, pair, f"{mark}$2{mark}")

    html = wrap(wrap(wrap(html, "b|strong", "**"), "i|em", "*"), "code", "`")
    # Only the address of a link is kept; its title attribute is not.
    link = (
        r"(?is)<a(?=\s)[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*?)*?\shref\s*=\s*"
        rf"(?:\"([^\"]*)\"|'([^']*)'){TAG_REST}>(.*?)</a\s*>"
    )
    return F.regexp_replace(html, link, "[$3]($1$2)")


def block_markdown(
    block: Column,
    converters: Mapping[str, Converter] | None = None,
    inline: Mapping[str, InlineConverter] | None = None,
) -> Column:
    """Markdown of one block; tables of converters take the place of the default ones."""
    table = default_converters() if converters is None else converters

    def converted(text: Column) -> Column:
        flat = F.regexp_replace(text, r"(?U)\s+", " ")
        result = flat
        for tag, convert in table.items():
            source = text if tag == "pre" else flat
            result = F.when(block["tag"] == tag, convert(source)).otherwise(result)
        return result

    written = _inline_markdown(block["html"]) if inline is None else _converted_inline(block["html"], inline)
    # Without inline tags the block's plain text already is the answer.
    marked = F.when(
        F.contains(block["html"], F.lit("<")),
        _trim(decode_entities(strip_tags(written))),
    ).otherwise(block["text"])
    return let(marked, converted)


def blocks_markdown(
    blocks: Column,
    converters: Mapping[str, Converter] | None = None,
    inline: Mapping[str, InlineConverter] | None = None,
) -> Column:
    """Markdown of a page: one paragraph per block."""
    return F.array_join(
        F.transform(blocks, lambda b: block_markdown(b, converters, inline)), "\n\n"
    )
