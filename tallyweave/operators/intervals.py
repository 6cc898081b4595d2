"""Validity intervals: inclusive ends, null is open. Every check is a sweep, never a pair list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.sliced import running_before

MIN_DATE, MAX_DATE = "0001-01-01", "9999-12-31"


def from_or_min(col: str | Column) -> Column:
    return F.coalesce(col, F.lit(MIN_DATE).cast("date"))


def to_or_max(col: str | Column) -> Column:
    return F.coalesce(col, F.lit(MAX_DATE).cast("date"))


def active_on(start: str, end: str, when: Column) -> Column:
    """Inclusive activity test with open ends."""
    return (from_or_min(start) <= when) & (when <= to_or_max(end))


def inverted(start: str, end: str) -> Column:
    """True where the end precedes the start (V7)."""
    return F.coalesce(F.col(end) < F.col(start), F.lit(False))


def _bounded(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.withColumn("_from", from_or_min(start)).withColumn("_to", to_or_max(end))


def _islands(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """The first day of each disjoint interval of each key, by one sweep.

    ``_reach`` is the last day of the interval before it (null at the first one of its key) and
    ``_final`` the last day of the whole key.
    """
    spans = _bounded(df, start, end).groupBy(*keys, "_from").agg(F.max("_to").alias("_to"))
    to = F.col("_to")
    swept = running_before(spans, keys, ["_from"],
                           {"_reach": ("max", to), "_rest": ("max_after", to)})
    opens = F.col("_reach").isNull() | (F.col("_from") > F.col("_reach"))
    return swept.filter(opens).select(
        *keys, "_from", "_reach", F.greatest("_to", "_reach", "_rest").alias("_final"))


def merge_intervals(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Union of the intervals of each key as disjoint intervals (columns _from, _to)."""
    opened = running_before(_islands(df, keys, start, end), keys, ["_from"],
                            {"_to": ("next", F.col("_reach"))})
    return opened.select(*keys, "_from", F.coalesce("_to", "_final").alias("_to"))


def overlap_conflicts(df: DataFrame, keys: list[str], identity: str, start: str,
                      end: str) -> DataFrame:
    """Intervals of one key that overlap an earlier interval of another identity.

    Intervals of the same identity are merged first, so any overlap left is between identities.
    Sorted by start, an overlap exists exactly where the furthest earlier end reaches the start;
    each finding names that furthest earlier interval as witness. The number of findings is at
    most the number of merged intervals.
    """
    merged = merge_intervals(df, keys + [identity], start, end)
    witness = F.struct(F.col("_to"), F.col(identity).alias("other"))
    swept = running_before(merged, keys, ["_from", "_to", identity],
                           {"_w": ("max", witness)})
    return swept.filter(F.col("_w._to") >= F.col("_from")).select(
        *keys, identity, F.col("_from").alias("starts"), F.col("_to").alias("ends"),
        F.col("_w.other").alias(f"other_{identity}"), F.col("_w._to").alias("other_ends"))


def adjacent_overlaps(df: DataFrame, keys: list[str], start: str, end: str,
                      tie: str) -> DataFrame:
    """Rows whose start is not after the end of the row just before them in their key."""
    spans = _bounded(df, start, end)
    seen = running_before(spans, keys, ["_from", tie],
                          {"previous_to": ("last", F.col("_to"))})
    return seen.filter(F.col("_from") <= F.col("previous_to")).drop("_from", "_to")


def overlaps_any(probes: DataFrame, spans: DataFrame, keys: list[str], start: str,
                 end: str, probe_columns: list[str]) -> DataFrame:
    """Probes whose interval meets at least one span of the same key.

    Spans enter the sweep at their start and probes at their end: a probe is hit when the
    furthest end among spans started by then reaches back to the probe's start.
    """
    none = F.lit(None)
    s = _bounded(spans, start, end).select(
        *keys, F.col("_from").alias("_at"), F.lit(0).alias("_kind"), F.col("_to").alias("_reach"),
        none.cast("date").alias("_need"),
        *[none.cast(probes.schema[c].dataType).alias(c) for c in probe_columns])
    p = _bounded(probes, start, end).select(
        *keys, F.col("_to").alias("_at"), F.lit(1).alias("_kind"),
        none.cast("date").alias("_reach"), F.col("_from").alias("_need"), *probe_columns)
    swept = running_before(s.unionByName(p), keys, ["_at", "_kind"],
                           {"_hit": ("max", F.col("_reach"))})
    # Probes of one instant may follow each other in any order: only spans feed the maximum.
    return swept.filter((F.col("_kind") == 1) & (F.col("_hit") >= F.col("_need"))).select(
        *keys, *probe_columns)


def resolve_as_of(probes: DataFrame, facts: DataFrame, keys: list[str], identity: str,
                  start: str, end: str, when: str) -> DataFrame:
    """The only identity valid at each probe's date, else null (core of J5).

    Distinct ``(keys, when)`` probes are swept together with the starts and ends of each
    identity's merged intervals. Running sums of a count and of an identity code tell how many
    identities are valid and, when it is one, which; matching pairs are never listed.
    """
    code = F.xxhash64(identity).cast("decimal(20,0)")

    def event(at: Column, n: int) -> Column:
        worth = (code * n).cast("decimal(20,0)")
        return F.struct(at.alias("_at"), F.lit(0).alias("_kind"), F.lit(n).alias("_n"),
                        worth.alias("_code"))

    # An opening also closes the interval before it; the first one closes the last of its key.
    last = F.when(F.col("_reach").isNull(), F.col("_final"))
    ended = [F.when(day < F.lit(MAX_DATE).cast("date"), event(F.date_add(day, 1), -1))
             for day in (F.col("_reach"), last)]
    events = _islands(facts, keys + [identity], start, end).select(
        *keys, F.inline(F.array_compact(F.array(event(F.col("_from"), 1), *ended))))
    asked = probes.select(*keys, F.col(when).alias("_at")).filter("_at is not null").distinct()
    asked = asked.select(*keys, "_at", F.lit(1).alias("_kind"), F.lit(0).alias("_n"),
                         F.lit(0).cast("decimal(20,0)").alias("_code"))
    swept = running_before(events.unionByName(asked), keys, ["_at", "_kind"],
                           {"_live": ("sum", F.col("_n")), "_which": ("sum", F.col("_code"))})
    hits = swept.filter((F.col("_kind") == 1) & (F.col("_live") == 1)).select(
        *keys, F.col("_at").alias(when), F.col("_which").cast("decimal(20,0)").alias("_code"))
    names = facts.select(*keys, identity, code.alias("_code")).distinct()
    return hits.join(names, [*keys, "_code"]).select(*keys, when, identity)
