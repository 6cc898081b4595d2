"""Ordered histories: progress audits, source ledgers, page events, freshness and retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.operators.sliced import count_since_last, running_before

PROGRESS_KEY = ["election_id", "jurisdiction_id", "source_id", "scope", "reporting_unit_id",
                "contest_id"]


def progress_findings(progress: DataFrame, tie: str | None = None) -> DataFrame:
    """Transitions of reporting progress that contradict each other.

    Rows are ordered by source time, else fetch time. Each value is compared with the last
    non-null value of its own kind, kept apart for counts and for completion.
    """
    rows = progress.withColumn("_at", F.coalesce("source_timestamp", "fetched_at"))
    order = ["_at", "fetched_at"] + ([tie] if tie else [])
    counts = F.col("kind") == "source_counts"
    done = F.col("kind") == "source_complete"
    seen = running_before(
        rows, PROGRESS_KEY, order,
        {
            "prior_reporting": ("last", F.when(counts, F.col("reporting_count"))),
            "prior_expected": ("last", F.when(counts, F.col("expected_count"))),
            "prior_complete": ("last", F.when(done, F.col("complete"))),
        },
    )

    def finding(rule: str, test: Column, before: Column, after: Column) -> Column:
        return F.when(test, F.struct(F.lit(rule).alias("finding"),
                                     before.cast("long").alias("before"),
                                     after.cast("long").alias("after")))

    reporting, expected = F.col("reporting_count"), F.col("expected_count")
    findings = F.array_compact(F.array(
        finding("cumulative_count_decreased",
                counts & (F.col("update_semantics") == "cumulative")
                & (reporting < F.col("prior_reporting")),
                F.col("prior_reporting"), reporting),
        finding("reporting_exceeds_expected", counts & (reporting > expected), expected,
                reporting),
        finding("expected_count_changed", counts & (expected != F.col("prior_expected")),
                F.col("prior_expected"), expected),
        finding("completion_regressed",
                done & F.col("prior_complete") & ~F.col("complete"),
                F.col("prior_complete").cast("int"), F.col("complete").cast("int")),
    ))
    keep = PROGRESS_KEY + ([tie] if tie else [])
    return seen.select(*keep, F.inline(findings))


def out_of_order(observations: DataFrame, keys: list[str], at: str, arrival: str) -> DataFrame:
    """Flag rows that arrive with a time before the latest time already accepted.

    Equal times are accepted. A refused row never moves the latest time forward, so the running
    maximum over all earlier arrivals is the latest accepted time.
    """
    seen = running_before(observations, keys, [arrival], {"_latest": ("max", F.col(at))})
    return seen.withColumn("refused", F.coalesce(F.col(at) < F.col("_latest"), F.lit(False))).drop(
        "_latest")


def fold_ledger(observations: DataFrame, keys: list[str], at: str, arrival: str) -> DataFrame:
    """Verification state per source from accepted observations.

    One failure never withdraws an earlier verification; reachability follows the newest check,
    of equal times the one that arrived last (``last_arrival``).
    """
    newest = F.struct(at, arrival)
    ok = F.col("verified")
    return observations.groupBy(*keys).agg(
        F.bool_or(ok).alias("ever_verified"),
        F.min(F.when(ok, F.col(at))).alias("first_verified_at"),
        F.max(F.when(ok, F.col(at))).alias("last_verified_at"),
        F.max(at).alias("last_checked_at"),
        F.max(newest)[arrival].alias("last_arrival"),
        F.max_by(ok, newest).alias("currently_reachable"),
        F.max_by(F.when(ok, F.lit("")).otherwise(F.col("failure_class")), newest)
        .alias("last_failure_class"),
    )


def merge_ledger(ledger: DataFrame, update: DataFrame, keys: list[str]) -> DataFrame:
    """Combine a stored ledger with the fold of newer observations (used per micro-batch)."""
    newest = F.struct("last_checked_at", "last_arrival")
    return ledger.unionByName(update).groupBy(*keys).agg(
        F.bool_or("ever_verified").alias("ever_verified"),
        F.min("first_verified_at").alias("first_verified_at"),
        F.max("last_verified_at").alias("last_verified_at"),
        F.max("last_checked_at").alias("last_checked_at"),
        F.max(newest)["last_arrival"].alias("last_arrival"),
        F.max_by("currently_reachable", newest).alias("currently_reachable"),
        F.max_by("last_failure_class", newest).alias("last_failure_class"),
    )


def page_events(captures: DataFrame, links: DataFrame, page: str, at: str) -> DataFrame:
    """Change events of captured pages and of the links seen on them.

    ``captures`` has page, time, ``digest`` and ``rules_digest``; ``links`` has page, time and
    ``link``. A first capture is a baseline; a new digest is a change; new rules over equal
    bytes are a reclassification. A link is discovered once per page, reappears after a capture
    without it, and is reported when the next capture lacks it.
    """
    around = running_before(captures, [page], [at], {
        "_prev": ("last", F.struct(F.col(at).alias("t"), "digest", "rules_digest")),
        "_next_t": ("next", F.col(at))})
    kind = (
        F.when(F.col("_prev").isNull(), "baseline_captured")
        .when(F.col("_prev.digest") != F.col("digest"), "page_changed")
        .when(F.col("_prev.rules_digest") != F.col("rules_digest"), "fingerprints_reclassified")
    )
    page_rows = around.withColumn("kind", kind).filter("kind is not null").select(
        page, at, "kind", F.col(page).cast("string").alias("link"))

    # A link marks its capture and the next one; a capture marked once only saw a change.
    marks = links.select(page, at, "link").join(around.select(page, at, "_next_t"), [page, at])
    here = F.struct(F.col(at).alias("at"), F.lit(1).alias("here"), F.lit(0).alias("was"))
    after = F.struct(F.col("_next_t").alias("at"), F.lit(0).alias("here"), F.lit(1).alias("was"))
    marks = marks.select(page, "link", F.inline(F.array_compact(F.array(
        here, F.when(F.col("_next_t").isNotNull(), after)))))
    turns = marks.groupBy(page, "link", "at").agg(
        F.max("here").alias("here"), F.max("was").alias("was")).filter("here <> was")
    first = links.groupBy(page, "link").agg(F.min(at).alias("_first"))
    kind = (F.when(F.col("here") == 0, "link_not_observed_this_capture")
            .when(F.col("at") == F.col("_first"), "candidate_discovered")
            .otherwise("candidate_reappeared"))
    link_rows = turns.join(first, [page, "link"]).select(
        page, F.col("at").alias(at), kind.alias("kind"), F.col("link").cast("string"))
    return page_rows.unionByName(link_rows)


def latest_events(events: DataFrame, order: str, keep: int) -> DataFrame:
    """The newest ``keep`` journal rows, as the retained state shows them."""
    return events.orderBy(F.col(order).desc()).limit(keep)


def feed_status(attempts: DataFrame, keys: list[str], at: str, arrival: str, now: Column,
                stale_after: Column, interval: Column, cap: int = 3600,
                max_exponent: int = 6) -> DataFrame:
    """Per feed: last success, staleness, failures in a row and next due time.

    ``attempts`` has ``status``; ``ok`` resets the failure count and ``failed`` adds one, while
    any other status leaves it. Times are epoch seconds.
    """
    ok = F.col("status") == "ok"
    newest = F.struct(at, arrival)
    base = attempts.groupBy(*keys).agg(
        F.max(F.when(ok, F.col(at))).alias("last_success"),
        F.max(at).alias("last_attempt"),
        F.max_by("status", newest).alias("status"),
        F.count(F.lit(1)).alias("attempts"),
    )
    failures = count_since_last(attempts, keys, [at, arrival], ok,
                                F.col("status") == "failed", "failures")
    out = base.join(failures, keys)
    wait = F.when(
        F.col("status") == "failed",
        backoff_seconds(interval, F.col("failures"), cap, max_exponent),
    ).otherwise(interval)
    return out.withColumn(
        "stale", F.col("last_success").isNull() | (now - F.col("last_success") > stale_after)
    ).withColumn("next_due", F.col("last_attempt") + wait)


def backoff_seconds(interval: Column, failures: Column, cap: int, max_exponent: int) -> Column:
    """``min(cap, interval * 2^min(failures-1, max_exponent))`` for at least one failure."""
    power = F.pow(F.lit(2), F.least(F.greatest(failures, F.lit(1)) - 1, F.lit(max_exponent)))
    return F.least(F.lit(cap), interval * power.cast("long"))


def lateness(pages: DataFrame, now: Column) -> DataFrame:
    """How late the page queue is: due, never visited, and the largest overdue time."""
    due = F.col("next_check_at")
    return pages.agg(
        F.count_if(F.coalesce(due, F.lit(0)) <= now).alias("remaining_due_pages"),
        F.count_if(due.isNull()).alias("unvisited_pages"),
        F.coalesce(F.max(F.greatest(F.lit(0), now - due)), F.lit(0))
        .alias("oldest_due_lateness_seconds"),
    )


def refresh_evidence(pairs: DataFrame, election_day: Column) -> DataFrame:
    """Accepted sample pairs that prove a feed refreshed.

    ``pairs`` has the change counts of two samples with ``old_at``, ``new_at``, both warning
    counts and whether their configuration is the same. First failing reason, or null.
    """
    def outside(c: str) -> Column:
        days = F.datediff(F.to_date(c), election_day)
        return (days < -1) | (days > 7)

    reason = (
        F.when(~F.col("same_config"), "different_configuration")
        .when((F.col("old_warnings") > 0) | (F.col("new_warnings") > 0), "unresolved_findings")
        .when(F.col("old_at") >= F.col("new_at"), "times_not_increasing")
        .when(outside("old_at") | outside("new_at"), "outside_reporting_window")
        .when((F.col("common_rows") == 0) | (F.col("changed_rows") == 0)
              | (F.col("removed_rows") > 0), "no_continuous_change")
        .when(F.col("decreased_rows") > 0, "cumulative_decrease")
    )
    return pairs.withColumn("refusal", reason).withColumn("refresh_verified", reason.isNull())


def mode_release_order(obs: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Order and lag in which modes first appear per jurisdiction."""
    first = obs.groupBy(*keys, "vote_mode").agg(F.min(at).alias("first_at"))
    # At most one row per mode and key reaches this window.
    w = Window.partitionBy(*keys)
    rank = F.rank().over(w.orderBy("first_at"))
    lag = F.unix_timestamp("first_at") - F.unix_timestamp(F.min("first_at").over(w))
    return first.select(*keys, "vote_mode", rank.alias("release_order"),
                        lag.alias("lag_seconds"))
