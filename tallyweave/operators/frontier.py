"""Work queues and frontiers: who to look at next, and why."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions import classify as C
from tallyweave.functions import urls as U
from tallyweave.operators.sliced import count_since_last
from tallyweave.session import bind

QUIET = "completed_no_new_urls"
FOUND = "observed_link_candidate"


def first_observed(evidence: DataFrame) -> DataFrame:
    """First time each unit's URL was seen."""
    return evidence.groupBy("jurisdiction_id", "url").agg(F.min("observed_at").alias("first_at"))


def discovery_frontier(units: DataFrame, evidence: DataFrame, attempts: DataFrame, now: Column,
                       quiet_limit: int = 3, monitor_interval: int = 86_400,
                       round_interval: int = 21_600) -> DataFrame:
    """Search state of every unit.

    After the newest evidence, a round with any find resets the count, a round with only quiet
    outcomes adds one, others change nothing. At the limit a unit is parked until its next daily
    review; newer evidence reopens it at once. Times are epoch seconds.
    """
    seen = first_observed(evidence).groupBy("jurisdiction_id").agg(
        F.max("first_at").alias("growth"), F.count(F.lit(1)).alias("urls"))
    rounds = attempts.filter("attempted_at > 0").groupBy("jurisdiction_id", "attempted_at").agg(
        F.bool_or(F.col("outcome") == FOUND).alias("found"),
        F.bool_and(F.col("outcome") == QUIET).alias("quiet"))
    last = rounds.groupBy("jurisdiction_id").agg(F.max("attempted_at").alias("last"))
    later = rounds.join(seen.select("jurisdiction_id", "growth"), "jurisdiction_id", "left")
    later = later.filter(F.col("attempted_at") > F.coalesce("growth", F.lit(0)))
    quiet = count_since_last(later, ["jurisdiction_id"], ["attempted_at"], F.col("found"),
                             F.col("quiet"), "quiet_rounds")
    out = (units.join(seen, "jurisdiction_id", "left").join(last, "jurisdiction_id", "left")
           .join(quiet, "jurisdiction_id", "left"))
    growth, last_at = F.coalesce("growth", F.lit(0)), F.coalesce("last", F.lit(0))
    rounds_quiet = F.coalesce("quiet_rounds", F.lit(0))
    parked = rounds_quiet >= quiet_limit
    wait = F.when(parked, F.lit(monitor_interval)).otherwise(F.lit(round_interval))
    due = F.when((growth > last_at) | (last_at == 0), F.lit(0)).otherwise(last_at + wait)
    return out.select(
        *units.columns,
        F.when(parked, "exhausted_for_now").otherwise("active").alias("discovery_status"),
        F.coalesce("urls", F.lit(0)).alias("observed_candidate_urls"),
        rounds_quiet.alias("completed_quiet_rounds"), last_at.alias("last_attempt_at"),
        growth.alias("last_new_evidence_at"), due.alias("next_search_at"),
        (now >= due).alias("search_due"))


def _turns(rows: DataFrame, group: str, order: list[Column], limit: int) -> DataFrame:
    """Number the rows of each group; only the first ``limit`` of a group can be chosen.

    The filter lets Spark limit each group before the shuffle, so a hot group stays small.
    """
    w = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn("turn", F.row_number().over(w)).filter(F.col("turn") <= limit)


def search_queue(frontier: DataFrame, limit: int = 20) -> DataFrame:
    """State round-robin over due units: states by latest attempt, units by oldest (K1)."""
    latest = frontier.groupBy("state").agg(F.max("last_attempt_at").alias("state_latest"))
    due = _turns(frontier.filter("search_due"), "state",
                 [F.col("last_attempt_at"), F.col("jurisdiction_id")], limit)
    return due.join(latest, "state").orderBy("turn", "state_latest", "state").limit(limit)


def due_pages(pages: DataFrame, now: Column, limit: int) -> DataFrame:
    """Due pages, each round ordered by the age of every state's oldest page (K2)."""
    due = pages.filter(F.coalesce("next_check_at", F.lit(0)) <= now).withColumn(
        "_checked", F.coalesce("last_checked_at", F.lit(0)))
    turns = _turns(due, "state", [F.col("_checked"), F.col("url")], limit)
    return turns.orderBy("turn", "_checked", "state").limit(limit).drop("_checked")


def seed_order(seeds: DataFrame, limit: int) -> DataFrame:
    """Seeds in state turns, states by name, fallback seeds last in their state (K3)."""
    turns = _turns(seeds, "state", [F.col("is_fallback"), F.col("url")], limit)
    return turns.orderBy("turn", "state").limit(limit)


def top_per_group(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of each group in a total order (K4, K5, K8)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def capped(rows: DataFrame, keys: list[str], order: list[Column], cap: int) -> tuple[
        DataFrame, DataFrame]:
    """Rows kept under a per-group cap, and the groups that had more with their size (K6).

    The cap is what the capture records; the second table reports every truncation.
    """
    kept = top_per_group(rows, keys, order, cap)
    over = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("candidates")).filter(
        F.col("candidates") > cap)
    return kept, over


def cap_at_expected(rows: DataFrame, expected: DataFrame, key: str, order: str) -> DataFrame:
    """Units of each state up to its expected number, in id order (K8)."""
    w = Window.partitionBy(key).orderBy(order)
    # Expected numbers come from a registry of states and bound what a group may keep.
    most = expected.agg(F.max("expected_primary_units").alias("_most"))
    ranked = rows.withColumn("_rank", F.row_number().over(w)).join(F.broadcast(most)).filter(
        F.col("_rank") <= F.col("_most")).drop("_most")
    return ranked.join(expected.select(key, "expected_primary_units"), key).filter(
        F.col("_rank") <= F.col("expected_primary_units")).drop("_rank")


def monitoring_seeds(seeds: DataFrame, candidates: DataFrame, frontier: DataFrame,
                     pages: DataFrame, now: Column, interval: int = 86_400,
                     keep: int = 3) -> DataFrame:
    """Seeds to visit now (K5, T8): units that are parked keep roots and their best pages.

    ``seeds`` has one row per url and unit (null unit: none); a seed is parked when all of its
    units are. ``candidates`` has unit, url, score.
    """
    parked = frontier.filter("discovery_status = 'exhausted_for_now'").select(
        F.col("jurisdiction_id").alias("unit"), F.lit(True).alias("_parked"))
    html = candidates.filter(~U.path(F.col("url")).rlike(U.ARTIFACT_PATTERN))
    best = top_per_group(html, ["unit"], [F.col("score").desc(), F.col("url").desc()], keep)
    best = best.select("unit", "url", F.lit(True).alias("_best"))
    state = (
        seeds.join(parked, "unit", "left").join(best, ["unit", "url"], "left")
        .groupBy("url").agg(
            F.coalesce(F.bool_and(F.col("unit").isNotNull() & F.col("_parked").isNotNull()),
                       F.lit(False)).alias("parked"),
            F.max("watch_depth").alias("depth"),
            F.bool_or(F.col("_best").isNotNull()).alias("best"))
        .join(pages.select("url", "last_success_at"), "url", "left")
    )
    fresh = F.col("last_success_at").isNotNull() & (now < F.col("last_success_at") + interval)
    skip = F.col("parked") & (((F.col("depth") > 0) & ~F.col("best")) | fresh)
    return state.filter(~skip).select("url", "parked")


def start_pages(direct: DataFrame, localities: DataFrame, central: DataFrame,
                per_unit: int = 2) -> DataFrame:
    """Where to look for every unit: its own pages, else its state's first directories.

    ``direct`` and ``central`` have url and page_role; fallback rows never claim to be a unit's
    own page.
    """
    own = direct.dropDuplicates(["jurisdiction_id", "page_role", "url"])
    without = localities.join(own.select("jurisdiction_id").distinct(), "jurisdiction_id",
                              "left_anti")
    entries = top_per_group(central.select("state", "url").distinct(), ["state"], [F.col("url")],
                            per_unit)
    fallback = without.join(entries, "state").select(
        "jurisdiction_id", "state", F.lit("state_directory_fallback").alias("page_role"), "url")
    return own.select("jurisdiction_id", "state", "page_role", "url").unionByName(fallback)


def start_gaps(starts: DataFrame, localities: DataFrame) -> DataFrame:
    """Units that have no page of their own, or no start at all."""
    have = starts.groupBy("jurisdiction_id").agg(
        F.bool_or(F.col("page_role") != "state_directory_fallback").alias("own"))
    return (
        localities.join(have, "jurisdiction_id", "left")
        .filter(~F.coalesce("own", F.lit(False)))
        .select("jurisdiction_id", "state", F.when(F.col("own").isNull(), "no_starting_url")
                .otherwise("state_fallback_only").alias("gap")))


def unit_actions(localities: DataFrame, starts: DataFrame, observed: DataFrame) -> DataFrame:
    """Next action per unit from its starts and the links observed on them.

    ``observed`` has parent and url. Only exact page provenance joins; counts replace URL lists,
    which stay in the long tables.
    """
    own = F.col("page_role") != "state_directory_fallback"
    child = observed.groupBy("parent").agg(F.count_distinct("url").alias("_children"))
    per_unit = (
        starts.join(child, F.col("url") == F.col("parent"), "left")
        .groupBy("jurisdiction_id")
        .agg(F.count_distinct(F.when(own, F.col("url"))).alias("direct_starts"),
             F.count_distinct(F.when(~own, F.col("url"))).alias("fallback_starts"),
             F.coalesce(F.sum(F.when(own, F.col("_children"))), F.lit(0))
             .alias("observed_leads")))
    out = localities.select("jurisdiction_id", "state").join(per_unit, "jurisdiction_id", "left")
    out = out.fillna(0, ["direct_starts", "fallback_starts", "observed_leads"])
    action = (
        F.when(F.col("observed_leads") > 0, "inspect_observed_result_leads")
        .when(F.col("direct_starts") > 0, "extract_links_from_local_start")
        .when(F.col("fallback_starts") > 0, "resolve_local_authority_from_state_directory")
        .otherwise("find_official_starting_page")
    )
    return out.withColumn("next_action", action)


def unit_buckets(localities: DataFrame, starts: DataFrame, clues: DataFrame,
                 catalog: DataFrame) -> DataFrame:
    """Readiness bucket per unit from start pages, directory clues and the catalog.

    ``catalog`` has url, parent, catalog_kind, target_status; a hunt matches a catalog row by its
    own URL or as its parent.
    """
    hunts = (
        starts.filter("page_role <> 'state_directory_fallback'").select("jurisdiction_id", "url")
        .unionByName(clues.select("jurisdiction_id", "url")).distinct())
    good = catalog.filter(F.col("catalog_kind").isin("dashboard_candidate", "results_page_lead"))
    fetched = F.col("target_status") == "fetched"
    keys = (good.select(F.col("url").alias("hunt"), fetched.alias("f"))
            .unionByName(good.select(F.col("parent").alias("hunt"), fetched.alias("f")))
            .groupBy("hunt").agg(F.bool_or("f").alias("observed")))
    found = hunts.join(keys, hunts.url == keys.hunt, "left").groupBy("jurisdiction_id").agg(
        F.bool_or(F.coalesce("observed", F.lit(False))).alias("observed"))
    bucket = (F.when(F.col("observed"), "observed_result_page_candidate")
              .when(F.col("observed").isNotNull(), "evidence_backed_hunting_location")
              .otherwise("unresolved_location"))
    return localities.join(found, "jurisdiction_id", "left").select(
        "jurisdiction_id", "state", bucket.alias("bucket"))


def known_leads(leads: DataFrame, localities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leads of a known unit in its own state, and the rejected rest."""
    key = localities.select("jurisdiction_id", "state").distinct()
    return (leads.join(key, ["jurisdiction_id", "state"], "left_semi"),
            leads.join(key, ["jurisdiction_id", "state"], "left_anti"))


def seed_associations(seeds: DataFrame, url: str, columns: list[str]) -> DataFrame:
    """Distinct associations of every usable seed URL, in long form."""
    out = U.normalize_urls(seeds, url, "seed_url")
    out = out.filter((F.col("seed_url") != "") & U.publishable(F.col("seed_url")))
    return out.select("seed_url", *columns).distinct()


def union_seeds(feeds: list[DataFrame]) -> DataFrame:
    """Followable seeds of several registries, unique by jurisdiction and URL.

    Each feed has jurisdiction_id, state, jurisdiction_level and url; later feeds win.
    """
    tagged = None
    for i, feed in enumerate(feeds):
        part = feed.select("jurisdiction_id", "state", "jurisdiction_level", "url",
                           F.lit(i).alias("_feed"))
        tagged = part if tagged is None else tagged.unionByName(part)
    safe = U.safe_urls(tagged, "url", "seed").filter(
        "seed is not null and jurisdiction_id <> ''")
    return safe.groupBy("jurisdiction_id", F.col("seed").alias("url")).agg(
        F.max_by("state", "_feed").alias("state"),
        F.max_by("jurisdiction_level", "_feed").alias("jurisdiction_level"))


def keep_first(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """First row of each key in an explicit input order."""
    others = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("_row"))
    return picked.select(*keys, "_row.*")


def keep_last(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last row of each key in an explicit input order."""
    others = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return picked.select(*keys, "_row.*")


def directory_seeds(links: DataFrame, order: str) -> DataFrame:
    """Inspection seeds from directory links that name exactly one unit."""
    from tallyweave.operators.links import GOOD_ROLES
    url = U.normalize_urls(links, "url", "_url")
    ok = url.filter(
        (F.col("match_status") == "unit_label_candidate")
        & (F.size("associated_unit_ids") == 1) & F.col("link_role").isin(GOOD_ROLES)
        & (F.coalesce("state", F.lit("")) != "") & (F.coalesce("observed_from", F.lit("")) != "")
        & F.col("snapshot_sha256").rlike("^[0-9a-f]{64}$") & (F.col("_url") != "")
        & U.publishable(F.col("_url")) & ~U.path(F.col("_url")).rlike(U.ARTIFACT_PATTERN))
    rows = ok.select(
        F.col("_url").alias("url"), F.col("state"),
        F.element_at("associated_unit_ids", 1).alias("unit"), "observed_from",
        "snapshot_sha256", F.lit("directory_inspection_lead").alias("page_role"),
        "match_basis", order)
    return keep_last(rows, ["url", "state", "unit", "observed_from", "snapshot_sha256"], order)


def harvested_sources(catalogs: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Leads of several catalogs as one, by the order of the catalogs (D3).

    A catalog is its origin, its rows with a state, the column of the address and one of the row order.
    Of equal states and addresses the first catalog's first row counts; only web addresses do.
    """
    parts = []
    for rank, (origin, rows, url, at) in enumerate(catalogs):
        parts.append(rows.select("state", F.trim(url).alias("source_url"),
                                 F.lit(origin).alias("source_origin"),
                                 F.struct(F.lit(rank).alias("rank"), F.col(at).cast("long").alias("at"))
                                 .alias("_order")))
    union = reduce(DataFrame.unionByName, parts).filter(
        F.col("source_url").rlike("^https?://"))
    first = keep_first(union, ["state", "source_url"], "_order").drop("_order")
    first = bind(first, _route=C.harvested_family(F.col("source_url")))
    parser = F.col("_route.route")
    # Every parser that the table names can be run as an adapter.
    stage = F.when(parser != "", "adapter_candidate").otherwise("needs_family_probe")
    return first.select(
        "state", "source_url", "source_origin", F.lit("candidate").alias("verification_status"),
        F.lit("untested").alias("fetch_status"), F.col("_route.family").alias("platform_family"),
        parser.alias("parser_family"), stage.alias("execution_stage"),
        F.when(parser != "", "existing_adapter_family").otherwise("").alias("notes"))
