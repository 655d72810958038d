"""Security indicators found in a text.

Each indicator is an expression from text to a list of values. Candidates are
maximal runs found by one linear pattern and then narrowed by a whole-match
test, so a long hash never counts as a short one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

Indicator = Callable[[Column], Column]

# Group names, in output order.
CVE = "CVE's"
ATTACK = "MITRE IDs"
IPV4 = "ipv4-adresses"
IPV6 = "ipv6-adresses"
EMAIL = "email-adresses"
URL = "urls"
MD5 = "MD5-hash"
SHA1 = "SHA1-hash"
SHA256 = "SHA256-hash"
SHA512 = "SHA512-hash"

# The two id patterns.
CVE_PATTERN = r"[Cc][Vv][Ee]-\d{4}-\d{4,7}"
ATTACK_PATTERN = r"(?:[TMSGO]|TA)\d{4}\.\d{3}"

_DOT = r"(?:[\[({\\]{0,2}\.[\])}]{0,2}|(?i:\[dot\]|\(dot\)|\{dot\}))"
_AT = r"(?:@|\[@\]|\(@\)|\{@\}|(?i:\[at\]|\(at\)|\{at\}))"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_GROUP = r"[0-9A-Fa-f]{1,4}"

_DOTTED_RUN = rf"[0-9]+(?:{_DOT}[0-9]+)*"
_IPV4_WHOLE = rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"
# Look-behinds start each run at its first character, so every text is read once.
_COLON_RUN = r"(?<![0-9A-Za-z_:])[0-9A-Za-z_]*+:[0-9A-Za-z_:]*+"
_COLON_HINT = r"::|[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"
_IPV6_FULL = rf"^(?:{_GROUP}:){{7}}{_GROUP}$"
_IPV6_SHORT = rf"^(?:{_GROUP}(?::{_GROUP}){{0,6}})?::(?:{_GROUP}(?::{_GROUP}){{0,6}})?$"
_EMAIL = (
    rf"(?<![A-Za-z0-9_.+-])[A-Za-z0-9_.+-]++{_AT}"
    rf"[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+"
)
_EMAIL_HINT = r"@|(?i:[\[({]at[\])}])"
_SLASHES = r"(?:\[://\]|\[?:\]?//)"
_URL_RUN = r"[^\s<>\"'`{}|^]+"
_URL = rf"(?i)(?:h(?:tt|xx)ps?|f[tx]p){_SLASHES}{_URL_RUN}(?:\{{\.\}}{_URL_RUN})*"
_HEX_RUN = r"[0-9A-Fa-f]{32,}"


def pattern_indicator(pattern: str, upper: bool = False) -> Indicator:
    """An indicator made of every match of one pattern."""

    def values(text: Column) -> Column:
        found = _find(text, pattern)
        return F.transform(found, F.upper) if upper else found

    return values


def _find(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _find_hinted(text: Column, hint: str, pattern: str) -> Column:
    """`_find` for texts that pass a cheaper test; most do not."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(hint), _find(text, pattern)).otherwise(none)


def _plain_dots(value: Column) -> Column:
    return F.regexp_replace(value, _DOT, ".")


def ipv4_addresses(text: Column) -> Column:
    runs = F.filter(_find(text, _DOTTED_RUN), lambda run: F.length(run) >= 7)
    return F.filter(F.transform(runs, _plain_dots), lambda ip: ip.rlike(_IPV4_WHOLE))


def ipv6_addresses(text: Column) -> Column:
    def whole(run: Column) -> Column:
        groups = F.size(F.filter(F.split(run, ":"), lambda g: g != ""))
        short = run.rlike(_IPV6_SHORT) & groups.between(1, 7)
        return run.rlike(_IPV6_FULL) | short

    return F.filter(_find_hinted(text, _COLON_HINT, _COLON_RUN), whole)


def email_addresses(text: Column) -> Column:
    def plain(found: Column) -> Column:
        return _plain_dots(F.regexp_replace(found, _AT, "@"))

    return F.transform(_find_hinted(text, _EMAIL_HINT, _EMAIL), plain)


def urls(text: Column) -> Column:
    def plain(found: Column) -> Column:
        found = F.regexp_replace(found, rf"^(?i)(?:hxx|htt)(ps?){_SLASHES}", "htt$1://")
        found = F.regexp_replace(found, rf"^(?i)f[tx]p{_SLASHES}", "ftp://")
        return F.regexp_replace(_plain_dots(found), r"[.,;:!?)\]]+$", "")

    return F.transform(_find(text, _URL), plain)


def hashes(digits: int) -> Indicator:
    """Hex runs of exactly `digits` digits."""

    def values(text: Column) -> Column:
        return F.filter(_find(text, _HEX_RUN), lambda run: F.length(run) == digits)

    return values


def default_indicators() -> dict[str, Indicator]:
    """The ten built-in groups; a copy, so a caller may add or replace entries."""
    return {
        CVE: pattern_indicator(CVE_PATTERN, upper=True),
        ATTACK: pattern_indicator(ATTACK_PATTERN, upper=True),
        IPV4: ipv4_addresses,
        IPV6: ipv6_addresses,
        EMAIL: email_addresses,
        URL: urls,
        MD5: hashes(32),
        SHA1: hashes(40),
        SHA256: hashes(64),
        SHA512: hashes(128),
    }


def extract_indicators(
    text: Column, indicators: Mapping[str, Indicator] | None = None
) -> Column:
    """Non-empty groups of distinct, sorted values: `array<struct<name, values>>`."""
    registry = default_indicators() if indicators is None else indicators
    groups = [
        F.struct(
            F.lit(name).alias("name"),
            F.sort_array(F.array_distinct(find(text))).alias("values"),
        )
        for name, find in registry.items()
    ]
    empty = F.array().cast("array<struct<name:string,values:array<string>>>")
    found = F.filter(F.array(*groups), lambda g: F.size(g["values"]) > 0)
    return F.when(text.isNotNull(), found).otherwise(empty)
