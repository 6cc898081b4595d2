"""Text folding, slugs and deterministic identifiers as Column expressions."""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Jurisdiction levels, and the prefixes of older jurisdiction ids.
JURISDICTION_LEVELS = ["state", "county", "county_equivalent", "parish", "borough",
                       "municipality", "town", "city", "ward", "election_authority"]
LEGACY_STATE_PREFIXES = {"mi-": "MI", "oh-": "OH", "pa-": "PA", "me-": "ME"}

_ASCII_ONLY = r"^[\x00-\x7F]*$"


@lru_cache(maxsize=None)
def _fold_tables() -> tuple[str, str, str, str]:
    """Compatibility decomposition of every code point that contains ASCII, by rule.

    Returns the one-to-one translation (from, to) and the one-to-many pieces as JSON plus a
    character class that detects them.
    """
    one_from, one_to, many = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        plain = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            one_from.append(char)
            one_to.append(plain)
        elif plain:
            many[char] = plain
    return "".join(one_from), "".join(one_to), json.dumps(many), _char_class(many)


def _char_class(chars) -> str:
    """Character class of code points, with neighbours written as ranges."""
    spans: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if spans and code == spans[-1][1] + 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in spans) + "]"


@lru_cache(maxsize=None)
def _word_tables() -> tuple[str, str, str, str, str]:
    """Code points whose decomposition, lowered, keeps any of ``a-z0-9``, by rule.

    Returns the one-to-one translation (from, to), the class of letters that a leftover mark
    separates from the next one, and the longer replacements as JSON with their class.
    """
    one_from, one_to, marked, more = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        text = unicodedata.normalize("NFKD", char).casefold()
        plain = "".join(c if c.isascii() and c.isalnum() else " " for c in text)
        letter = plain.strip()
        if len(letter) == 1 and plain[0] == letter:
            one_from.append(char)
            one_to.append(letter)
            if len(plain) > 1:
                marked.append(char)
        elif letter:
            more[char] = plain
    return ("".join(one_from), "".join(one_to), _char_class(marked), json.dumps(more),
            _char_class(more))


def _replace_chars(value: Column, table_json: str) -> Column:
    table = F.from_json(F.lit(table_json), "map<string,string>")
    return F.array_join(
        F.transform(F.split(value, ""), lambda c: F.coalesce(F.element_at(table, c), c)), "")


def ascii_fold(value: Column) -> Column:
    """Compatibility-decompose and drop what is not ASCII (U4), all on the JVM side.

    Decomposition works code point by code point, so a translation table generated from the
    Unicode database is exact; no Python worker is started.
    """
    src, dst, many, many_class = _fold_tables()
    full = F.when(value.rlike(many_class), _replace_chars(value, many)).otherwise(value)
    full = F.regexp_replace(F.translate(full, src, dst), r"[^\x00-\x7F]+", "")
    return F.when(value.rlike(_ASCII_ONLY), value).otherwise(full)


def _slug(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(value), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def token(value: Column) -> Column:
    """Slug of folded text (F1)."""
    return _slug(ascii_fold(value))


def alias_token(value: Column) -> Column:
    """Slug without folding (F2)."""
    return _slug(F.trim(value))


def mode_label(value: Column) -> Column:
    """Lower-case label with single spaces."""
    return F.trim(F.regexp_replace(F.lower(value), r"[^a-z0-9]+", " "))


def words(value: Column) -> Column:
    """Folded text as lower-case words; a stripped accent separates words."""
    src, dst, marked, more, more_class = _word_tables()
    spread = F.regexp_replace(value, marked, "$0 ")
    longer = F.when(value.rlike(more_class), _replace_chars(spread, more)).otherwise(spread)
    text = F.when(value.rlike(_ASCII_ONLY), value).otherwise(F.translate(longer, src, dst))
    return F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " "))


def state_of_jurisdiction(jurisdiction_id: Column) -> Column:
    """Two-letter state of a canonical or older jurisdiction id."""
    low = F.lower(jurisdiction_id)
    out = F.when(low.rlike("^us:[^:]{2}(:|$)"), F.upper(F.split(low, ":")[1]))
    for prefix, state in LEGACY_STATE_PREFIXES.items():
        out = out.when(low.startswith(prefix), F.lit(state))
    return out


def _state_code(state: Column) -> Column:
    st = F.upper(F.trim(state))
    return F.when(st.rlike("^[A-Z]{2}$"), F.lower(st))


def _key(external_id: Column, name: Column) -> Column:
    key = F.when(F.trim(F.coalesce(external_id, F.lit(""))) != "", token(external_id)).otherwise(
        token(name))
    return F.when(key != "", key)


def _joined(sep: str, *parts: Column) -> Column:
    """Concatenate with null as soon as one part is null (invalid input gives no id)."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(part)
    return F.concat(*pieces)


def jurisdiction_id(state: Column, level: Column, name: Column,
                    external_id: Column = None) -> Column:
    """``us:{state}:{level}:{key}``; null when state, level or key is not valid."""
    external_id = F.lit("") if external_id is None else external_id
    lvl = F.when(level.isin(JURISDICTION_LEVELS), token(level))
    return _joined(":", F.lit("us"), _state_code(state), lvl, _key(external_id, name))


def scoped_authority_id(jurisdiction: Column, kind: Column, ordinal: Column) -> Column:
    """``{jurisdiction}:authority:{kind}:{n}`` (F8)."""
    k = F.when(token(kind) != "", token(kind))
    return F.when(jurisdiction.startswith("us:") & (ordinal >= 1), _joined(
        ":", jurisdiction, F.lit("authority"), k, ordinal.cast("string")))


def election_authority_id(state: Column, kind: Column, name: Column,
                          external_id: Column = None) -> Column:
    """``us:authority:{state}:{kind}:{key}``, independent of served area."""
    external_id = F.lit("") if external_id is None else external_id
    k = F.when(token(kind) != "", token(kind))
    return _joined(":", F.lit("us:authority"), _state_code(state), k, _key(external_id, name))


def reporting_regime_id(jurisdiction: Column, election: Column, kind: Column,
                        source: Column) -> Column:
    """``{jurisdiction}:election:{e}:regime:{kind}:{source}``."""
    parts = [F.when(token(c) != "", token(c)) for c in (election, kind, source)]
    return F.when(jurisdiction.startswith("us:"), _joined(
        ":", jurisdiction, F.lit("election"), parts[0], F.lit("regime"), parts[1], parts[2]))


def reporting_unit_id(state: Column, election: Column, regime_id: Column, unit_type: Column,
                      raw_name: Column, native_id: Column = None) -> Column:
    """Unit id under a regime; null unless state and election agree with the regime."""
    native_id = F.lit("") if native_id is None else native_id
    agrees = (
        regime_id.startswith(F.concat(F.lit("us:"), _state_code(state), F.lit(":")))
        & regime_id.contains(F.concat(F.lit(":election:"), token(election), F.lit(":regime:")))
    )
    return F.when(agrees, _joined(":", regime_id, F.lit("reporting-unit"), unit_type,
                                  _key(native_id, raw_name)))


def stable_observation_id(source: Column, election: Column, county: Column,
                          label: Column) -> Column:
    """First 20 hex digits of the hash over unit-separated fields."""
    parts = [F.coalesce(c, F.lit("")) for c in (source, election, county, label)]
    return F.left(F.sha2(F.concat_ws("\x1f", *parts), 256), F.lit(20))


def content_digest(body: Column) -> Column:
    """SHA-256 of a binary or string body."""
    return F.sha2(body, 256)


def canonical_json_digest(*columns: str) -> Column:
    """SHA-256 over JSON with name-ordered fields; nulls are written out."""
    fields = F.struct(*[F.col(c) for c in sorted(columns)])
    return F.sha2(F.to_json(fields, {"ignoreNullFields": "false"}), 256)
