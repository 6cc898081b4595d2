"""Page text, tags and attributes by regular expression, as Column expressions."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyweave.session import let

_DROP = (r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>|<![^>]*>|</?[a-z][^>]*>")


@lru_cache(maxsize=None)
def _entities() -> tuple[str, str, str]:
    """Named character references from the standard table, by rule.

    Returns the references that end in a semicolon as JSON, the older ones that may lack it as
    JSON, and an alternation of the older names, longest first.
    """
    full = {k[:-1]: v for k, v in html5.items() if k.endswith(";")}
    bare = {k: v for k, v in html5.items() if not k.endswith(";")}
    names = "|".join(sorted(bare, key=len, reverse=True))
    return json.dumps(full), json.dumps(bare), names


def unescape(value: Column) -> Column:
    """Replace named and numeric character references, each once."""
    full, bare, names = _entities()
    full_map = F.from_json(F.lit(full), "map<string,string>")
    bare_map = F.from_json(F.lit(bare), "map<string,string>")

    def piece(p: Column) -> Column:
        dec = F.regexp_extract(p, r"^#([0-9]+);?", 1)
        hexa = F.regexp_extract(p, r"^#[xX]([0-9a-fA-F]+);?", 1)
        name = F.regexp_extract(p, r"^([A-Za-z][A-Za-z0-9]*);", 1)
        old_name = F.regexp_extract(p, rf"^({names})", 1)

        def rest(pattern: str) -> Column:
            return F.regexp_replace(p, pattern, "")

        def older() -> Column:
            return let(old_name, lambda o: F.when(o != "", F.concat(
                F.element_at(bare_map, o), F.substr(p, F.length(o) + 1)))
                .otherwise(F.concat(F.lit("&"), p)))

        number = let(F.when(dec != "", _number(dec, 10)).otherwise(_number(hexa, 16)), _code_point)
        return (
            F.when(p.rlike("^#(?:[0-9]|[xX][0-9a-fA-F])"), F.concat(
                number, rest(r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?")))
            .otherwise(let(F.element_at(full_map, name), lambda found: F.when(
                found.isNotNull(), F.concat(found, rest(r"^[A-Za-z][A-Za-z0-9]*;")))
                .otherwise(older())))
        )

    def rebuilt(parts: Column) -> Column:
        return F.concat(F.element_at(parts, 1), F.array_join(F.transform(
            F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), piece), ""))

    return let(value, lambda v: F.when(v.contains("&"), let(F.split(v, "&"), rebuilt)).otherwise(v))


# What the references 128 to 159 stand for in the standard (windows-1252); the five
# without an entry stand for themselves.
_WINDOWS = {k: ord(bytes([k]).decode("cp1252")) for k in range(128, 160)
            if k not in (129, 141, 143, 144, 157)}
_REPLACEMENT = 0xFFFD


def _number(digits: Column, base: int) -> Column:
    """The code point that digits of any number stand for, by the standard's rules."""
    table = F.create_map(*[F.lit(x) for pair in _WINDOWS.items() for x in pair])

    def checked(n: Column) -> Column:
        invalid = n.isNull() | (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        return F.when(invalid, F.lit(_REPLACEMENT).cast("long")).otherwise(
            F.coalesce(F.element_at(table, n.cast("int")).cast("long"), n))

    return let(let(F.regexp_replace(digits, "^0+", ""), lambda plain: F.when(
        F.length(plain) <= 7, F.conv(F.concat(F.lit("0"), plain), base, 10).cast("long"))), checked)


def _code_point(n: Column) -> Column:
    """Character of a code point, encoded as UTF-8 bytes."""
    def byte(v: Column) -> Column:
        return F.lpad(F.hex(v), 2, "0")

    six = F.lit(0x3F)
    tail = [F.lit(0x80) + F.shiftright(n, s).bitwiseAND(six) for s in (0, 6, 12)]
    hexed = (
        F.when(n < 0x80, byte(n))
        .when(n < 0x800, F.concat(byte(F.lit(0xC0) + F.shiftright(n, 6)), byte(tail[0])))
        .when(n < 0x10000, F.concat(byte(F.lit(0xE0) + F.shiftright(n, 12)), byte(tail[1]),
                                    byte(tail[0])))
        .otherwise(F.concat(byte(F.lit(0xF0) + F.shiftright(n, 18)), byte(tail[2]),
                            byte(tail[1]), byte(tail[0])))
    )
    return F.decode(F.unhex(hexed), "UTF-8")


def text_of(html: Column) -> Column:
    """Visible text: strings between tags, trimmed, joined by one space, unescaped."""
    flat = F.regexp_replace(html, _DROP, "\x01")
    joined = F.regexp_replace(flat, r"\s*\x01[\s\x01]*", " ")
    return unescape(F.regexp_replace(joined, r"^\s+|\s+$", ""))


# The same on the text of one page, for the functions over Arrow batches that read its elements.
def plain_pattern(pattern: str) -> re.Pattern:
    """A pattern of Java's as one of Python's: ASCII classes and case, but letters of all scripts at \\b."""
    return re.compile("(?a)" + pattern.replace(r"\b", r"(?u:\b)").replace(r"\z", r"\Z"))


_WHITE = " \t\n\x0b\f\r"
_TAGS = plain_pattern(_DROP)
_GAP = re.compile(rf"[{_WHITE}]*\x01[{_WHITE}\x01]*")
#: Java's ``$`` also stands before one of these at a text's end.
_LINE_ENDS = ("\x85", "\u2028", "\u2029")
_EDGE = re.compile(rf"\A[{_WHITE}]+|[{_WHITE}]+(?=.?\Z)")
_NUMERIC = re.compile(r"#(?:([0-9]+)|[xX]([0-9a-fA-F]+));?")
_NAMED = re.compile(r"([A-Za-z][A-Za-z0-9]*);")


@lru_cache(maxsize=None)
def _references() -> tuple[dict[str, str], dict[str, str], re.Pattern]:
    full, bare, names = _entities()
    return json.loads(full), json.loads(bare), re.compile(names)


def _replaced(piece: str) -> str:
    """A text after an ampersand with its reference replaced."""
    full, bare, names = _references()
    found = _NUMERIC.match(piece)
    if found:
        digits = (found[1] or found[2]).lstrip("0")
        n = int("0" + digits, 10 if found[1] else 16) if len(digits) <= 7 else 0
        n = _REPLACEMENT if not 0 < n <= 0x10FFFF or 0xD800 <= n <= 0xDFFF else _WINDOWS.get(n, n)
        return chr(n) + piece[found.end():]
    found = _NAMED.match(piece)
    if found and found[1] in full:
        return full[found[1]] + piece[found.end():]
    found = names.match(piece)
    return bare[found[0]] + piece[found.end():] if found else "&" + piece


def plain_text(html: str) -> str:
    """``text_of`` of one text."""
    text = html
    if "<" in html:
        text = _TAGS.sub("\x01", html)
    if "\x01" in text:
        text = _GAP.sub(" ", text)
    text = _EDGE.sub("", text) if text.endswith(_LINE_ENDS) else text.strip(_WHITE)
    if "&" not in text:
        return text
    first, *pieces = text.split("&")
    return first + "".join(map(_replaced, pieces))


def attribute_pattern(name: str) -> str:
    return rf"(?is)(?:^|[\s\"'/]){name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute inside an opening tag's text; null when it is absent."""
    pattern = attribute_pattern(name)
    return let(tag, lambda t: F.when(
        t.rlike(pattern), F.concat(*[F.regexp_extract(t, pattern, i) for i in (1, 2, 3)])))


def elements(html: Column, name: str) -> Column:
    """All ``<name ...>...</name>`` elements of one page as an array of their text."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{name}\b[^>]*>.*?</{name}\s*>"), F.lit(0))


def open_tags(html: Column, name: str) -> Column:
    """All opening tags of a name, as an array."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{name}\b[^>]*>"), F.lit(0))


def first_element_text(html: Column, name: str) -> Column:
    """Text of the first element of a name, or null."""
    found = F.regexp_extract(html, rf"(?is)<{name}\b[^>]*>(.*?)</{name}\s*>", 1)
    return let(found, lambda inner: F.when(inner != "", text_of(inner)))


def table_cells(row: Column) -> Column:
    """Cell texts of one table row."""
    cells = F.regexp_extract_all(row, F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]\s*>"), F.lit(1))
    return F.transform(cells, text_of)
