"""Cleaning of advert titles and descriptions, as native expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacanta.fixed_values import (
    BRACKETED_PART,
    BULLET_GLYPHS,
    BULLET_REPLACEMENT,
    TAB_BULLET,
    URL_START,
)

# White space as the Unicode property plus the four ASCII separators. Without (?U)
# Java's \s covers ASCII only and no-break spaces would survive.
_SPACES = r"(?U)[\s\x1c-\x1f]"
_NO_SPACES = r"(?U)[^\s\x1c-\x1f]"
_SPACES_IN_LINE = r"(?U)[\s\x1c-\x1f&&[^\n]]"

_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

# Elements whose text is not shown, then everything else between angle brackets.
_UNSHOWN = r"(?is)<(script|style|template|rt|rp)\b[^>]*>.*?(?:</\1\s*>|\z)"
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_CDATA = r"(?s)<!\[CDATA\[(.*?)\]\]>"
_DECLARATION = r"<[!?][^>]*>"
_URL_OR_BULLET = rf"{URL_START}|[{BULLET_GLYPHS}]|{TAB_BULLET}"
_TAG = r"""</?[A-Za-z][^'">]*+(?:(?:"[^"]*+"|'[^']*+')[^'">]*+)*+>"""


def bind(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body(c)`` with ``c`` evaluated once, however often ``body`` refers to it.

    It also leaves a single reference to ``c`` in the expression. Spark moves filters
    on derived columns below the select that derives them, copying the expression for
    each reference; with one reference each, nothing multiplies.
    """
    return F.get(F.transform(F.array(c), body), F.lit(0))


def strip(c: Column) -> Column:
    """Trim white space of every kind; the built-in trim takes U+0020 only."""
    return F.regexp_replace(c, rf"\A{_SPACES}+|{_SPACES}+\z", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | c.rlike(rf"\A{_SPACES}*\z")


# --- character references ---------------------------------------------------------


@cache
def _names_table() -> str:
    """Names and their text from the HTML5 table, the common ones first.

    A map literal is searched front to back, so the order pays.
    """
    common = ["amp;", "nbsp;", "quot;", "lt;", "gt;", "pound;", "middot;", "bull;", "copy;"]
    names = common + sorted(set(html5) - set(common))
    return "\x01".join(f"{name}\x02{html5[name]}" for name in names)


@cache
def _unterminated_names() -> str:
    """Alternation of the names that are valid without a semicolon, longest first."""
    names = [name for name in html5 if not name.endswith(";")]
    return "|".join(sorted(names, key=len, reverse=True))


@cache
def _special_points() -> str:
    """Code points that do not stand for themselves in a numeric reference.

    128-159 mean Windows-1252 characters; controls and non-characters give nothing.
    """
    texts = dict.fromkeys([*range(1, 9), 11, *range(14, 32), 127, *range(0xFDD0, 0xFDF0)], "")
    for plane in range(17):
        texts[plane * 0x10000 + 0xFFFE] = texts[plane * 0x10000 + 0xFFFF] = ""
    for point in range(0x80, 0xA0):
        texts[point] = bytes([point]).decode("cp1252", errors="ignore") or chr(point)
    texts |= {0: "\ufffd", 13: "\r"}
    return "\x01".join(f"{point}\x02{text}" for point, text in texts.items())


def _lookup(table: str, key: Column) -> Column:
    # The optimizer folds the table into one map literal.
    return F.try_element_at(F.str_to_map(F.lit(table), F.lit("\x01"), F.lit("\x02")), key)


def _numeric_reference(reference: Column) -> Column:
    digits = F.regexp_extract(reference, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
    in_hex = reference.rlike("^&#[xX]")
    number = F.when(in_hex, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10))
    # Past seven digits no code point exists in either base. No digits means zeros.
    point = F.when(F.length(digits) <= 7, F.coalesce(number.try_cast("int"), F.lit(0)))

    def text(p: Column) -> Column:
        stands_for_itself = (p <= 0x10FFFF) & ~p.between(0xD800, 0xDFFF)
        return F.coalesce(
            _lookup(_special_points(), p.cast("string")),
            F.when(stands_for_itself, F.decode(F.unhex(F.lpad(F.hex(p), 8, "0")), "UTF-32")),
            F.lit("\ufffd"),
        )

    return bind(point, text)


def _named_reference(reference: Column) -> Column:
    """Exact name, else the longest name it starts with, else the text unchanged."""
    prefix = rf"^&({_unterminated_names()})(?s:(.*))$"
    return F.coalesce(
        _lookup(_names_table(), F.substring(reference, 2, 40)),
        F.concat(
            _lookup(_names_table(), F.nullif(F.regexp_extract(reference, prefix, 1), F.lit(""))),
            F.regexp_extract(reference, prefix, 2),
        ),
        reference,
    )


def unescape(c: Column) -> Column:
    """Replace character references by their text, in one pass.

    The text is cut at the references and joined again with each one decoded, so
    decoded text is never read a second time.
    """

    def decoded(text: Column) -> Column:
        return F.array_join(
            F.zip_with(
                F.split(text, _REFERENCE, -1),
                F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)),
                lambda piece, reference: F.concat(
                    piece,
                    F.when(reference.isNull(), F.lit(""))
                    .when(reference.startswith("&#"), _numeric_reference(reference))
                    .otherwise(_named_reference(reference)),
                ),
            ),
            "",
        )

    return bind(c, lambda text: F.when(text.contains("&"), decoded(text)).otherwise(text))


# --- the cleaning steps -------------------------------------------------------------


def strip_html(c: Column) -> Column:
    """Text of an HTML fragment on one line with single spaces."""

    def without_markup(text: Column) -> Column:
        shown = F.regexp_replace(text, _UNSHOWN, " ")
        shown = F.regexp_replace(shown, _COMMENT, " ")
        shown = F.regexp_replace(shown, _CDATA, " $1 ")
        shown = F.regexp_replace(shown, _DECLARATION, " ")
        shown = F.regexp_replace(shown, _TAG, " ")
        # All of these begin with the sign that is looked for.
        return F.when(text.contains("<"), shown).otherwise(text)

    text = unescape(bind(c, without_markup))
    return F.trim(F.regexp_replace(text, rf"{_SPACES}+", " "))


def remove_urls(c: Column) -> Column:
    return F.regexp_replace(c, rf"{URL_START}{_NO_SPACES}+", " ")


def normalize_bullets(c: Column) -> Column:
    return F.regexp_replace(c, rf"[{BULLET_GLYPHS}]|{TAB_BULLET}", BULLET_REPLACEMENT)


def normalize_whitespace(c: Column) -> Column:
    """Single spaces within lines, at most one empty line, nothing at the ends."""
    text = F.regexp_replace(c, rf"{_SPACES_IN_LINE}+", " ")
    return F.trim(F.regexp_replace(text, r"\n{3,}", "\n\n"), F.lit(" \n"))


def clean_description(c: Column) -> Column:
    """Plain text of a raw description; '' for null or blank."""

    def lines(text: Column) -> Column:
        laid_out = normalize_whitespace(normalize_bullets(remove_urls(text)))
        # Stripped text is one line with single spaces: without these it is ready.
        return F.when(text.rlike(_URL_OR_BULLET), laid_out).otherwise(text)

    return bind(strip_html(unescape(F.coalesce(c, F.lit("")))), lines)


def clean_title(c: Column) -> Column:
    """Plain text of a raw title without bracketed remarks; '' for null."""

    def without_remarks(text: Column) -> Column:
        cut = F.regexp_replace(text, rf"{_SPACES}*{BRACKETED_PART}{_SPACES}*", " ")
        remarked = text.contains("(") | text.contains("[")
        return F.when(remarked, normalize_whitespace(cut)).otherwise(text)

    return bind(strip_html(unescape(F.coalesce(c, F.lit("")))), without_remarks)
