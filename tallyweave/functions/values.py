"""Numbers, dates and first-present values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_int(value: Column) -> Column:
    """Integer with optional commas, else null."""
    text = F.trim(F.replace(value, F.lit(","), F.lit("")))
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("long"))


def strict_count(value: Column) -> Column:
    """Plain or correctly grouped non-negative count, else null."""
    text = F.trim(value)
    return F.when(text.rlike(r"^(?:\d+|\d{1,3}(?:,\d{3})+)$"),
                  F.replace(text, F.lit(","), F.lit("")).try_cast("long"))


def digits_or_zero(value: Column) -> Column:
    """All digits and minus signs taken together; blank is zero."""
    text = F.regexp_replace(F.coalesce(value, F.lit("")), "[^0-9-]", "")
    return F.when(text.isin("", "-"), F.lit(0).cast("long")).otherwise(text.try_cast("long"))


def first_int(value: Column) -> Column:
    """First integer in a text, ignoring percent signs."""
    found = F.regexp_extract(F.replace(value, F.lit("%"), F.lit("")), r"(-?\d[\d,]*)", 1)
    return F.when(found != "", F.replace(found, F.lit(","), F.lit("")).try_cast("long"))


def labeled_int(text: Column, label: str, colon: str = ":") -> Column:
    """Integer that follows a label (F42); ``colon`` may be a pattern such as ``:?``."""
    escaped = reduce(lambda s, c: s.replace(c, "\\" + c), ".()+*?[]", label)
    found = F.regexp_extract(text, rf"(?i){escaped}\s*{colon}\s*([\d,]+)", 1)
    return F.when(found != "", F.replace(found, F.lit(","), F.lit("")).try_cast("long"))


def present(value: Column) -> Column:
    """Trimmed text, null when blank."""
    text = F.trim(value.cast("string"))
    return F.when(text != "", text)


def first_present(*values: Column) -> Column:
    """First value that is neither null nor blank, trimmed."""
    return F.coalesce(*[present(v) for v in values]) if values else F.lit(None).cast("string")


def instant_seconds(value: Column) -> Column:
    """Epoch seconds of an ISO time that states its zone; anything else is 0."""
    zoned = value.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    text = F.regexp_replace(value, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(zoned, F.coalesce(F.unix_micros(F.try_to_timestamp(text)) / 1_000_000,
                                    F.lit(0.0))).otherwise(F.lit(0.0))


def report_time(text: Column) -> Column:
    """Creation time printed on a report page (F20); the weekday is dropped before parsing."""
    raw = F.regexp_extract(text, r"This report created:\s*(.+)", 1)
    raw = F.trim(F.regexp_replace(raw, r"(?s) Registered Voters:.*$", ""))
    found = F.regexp_extract(
        raw, r"^\w+day,\s+(\w+ \d{1,2}, \d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm])$", 1)
    return F.coalesce(
        F.try_to_timestamp(F.when(found != "", found), F.lit("MMM d, yyyy h:mm:ss a")),
        F.try_to_timestamp(F.when(found != "", found), F.lit("MMMM d, yyyy h:mm:ss a")),
    )


def attach_zone(naive: Column, zone: Column | str) -> Column:
    """Instant of a local time in the feed's zone."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.to_utc_timestamp(naive, zone)


def in_archive_window(day: Column, election_day: Column) -> Column:
    """Three days before to ten days after an election day."""
    return day.between(F.date_sub(election_day, 3), F.date_add(election_day, 10))


def split_links(value: Column) -> Column:
    """Non-blank parts of a ``a | b`` cell."""
    return F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), r" \| "), lambda p: F.trim(p)),
                    lambda p: p != "")
