"""Coverage accounting: capabilities, trackers, censuses, gap matrices and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import classify as C
from tallyweave.functions import urls as U
from tallyweave.functions.ids import stable_observation_id
from tallyweave.functions.values import first_present, split_links
from tallyweave.operators.intervals import active_on

# Statuses, finer units and result scopes.
POSITIVE = ["verified", "affirmatively_adjudicated", "migrated_positive"]
STATUSES = ["enumerated_unresolved", "final_only", "election_night_only", "both",
            "known_missing_source"]
FINE_UNITS = ["precinct", "ward", "district"]
PRECINCT_COLUMNS = ["precinct", "precinct_name", "reporting_unit", "reporting_unit_name",
                    "ward_precinct"]


def derived_capabilities(capabilities: DataFrame, when: Column | None = None) -> DataFrame:
    """Final and live flags per jurisdiction from positive, active rows (A3)."""
    rows = capabilities.filter(F.col("verification_status").isin(POSITIVE))
    if when is not None:
        rows = rows.filter(active_on("valid_from", "valid_to", when))
    return rows.groupBy("jurisdiction_id").agg(
        F.bool_or(F.col("capability_type") == "final").alias("final"),
        F.bool_or(F.col("capability_type") == "election_night").alias("live"))


def overlay_status(localities: DataFrame, capabilities: DataFrame) -> DataFrame:
    """Coverage status of each unit from its capabilities.

    No positive record means unresolved; only an explicit adjudication means missing.
    """
    out = localities.join(capabilities, "jurisdiction_id", "left")
    final, live = F.coalesce("final", F.lit(False)), F.coalesce("live", F.lit(False))
    status = (
        F.when(final & live, "both").when(final, "final_only").when(live, "election_night_only")
        .when(F.col("coverage_status") == "known_missing_source", "known_missing_source")
        .otherwise("enumerated_unresolved")
    )
    return out.withColumn("coverage_status", status).drop("final", "live")


def coverage_tracker(localities: DataFrame, denominators: DataFrame,
                     national: bool = True) -> DataFrame:
    """Five status counts and their sums per state, with a national row.

    Status counts come from one aggregate. ``overrun`` marks states that enumerate more units
    than expected, which strict callers refuse.
    """
    counts = localities.groupBy("state").agg(*[
        F.count_if(F.col("coverage_status") == s).alias(s) for s in STATUSES])
    rows = denominators.select("state", "expected_primary_units").join(counts, "state", "left")
    rows = rows.fillna(0, STATUSES)
    if national:
        values = ["expected_primary_units", *STATUSES]
        rows = rows.rollup("state").agg(*[F.sum(c).alias(c) for c in values],
                                        F.grouping("state").alias("_total"))
        rows = rows.withColumn("state", F.when(F.col("_total") == 1, "US").otherwise(
            F.col("state").cast("string"))).drop("_total")
    enumerated = reduce(lambda a, b: a + b, [F.col(s) for s in STATUSES])
    return rows.select(
        "state", "expected_primary_units", *STATUSES,
        (F.col("expected_primary_units") - enumerated).alias("estimated_unknown_units"),
        (F.col("final_only") + F.col("election_night_only") + F.col("both"))
        .alias("with_any_source"),
        (F.col("final_only") + F.col("both")).alias("with_final"),
        (F.col("election_night_only") + F.col("both")).alias("with_election_night"),
        (enumerated > F.col("expected_primary_units")).alias("overrun"))


def tracker_violations(tracker: DataFrame) -> DataFrame:
    """Rows whose parts do not add up to the expected number, or are negative."""
    parts = [F.col(s) for s in STATUSES] + [F.col("estimated_unknown_units")]
    total = reduce(lambda a, b: a + b, parts)
    bad = (total != F.col("expected_primary_units")) | (
        F.least(F.col("expected_primary_units"), *parts) < 0)
    return tracker.filter(bad).select("state")


def histogram(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``value:count`` pairs per key in value order, ``none`` when empty (A5).

    Values are counted before they are gathered, so a hot key gathers one entry per value.
    """
    filled = F.coalesce(first_present(F.col(value)), F.lit("unknown"))
    counts = rows.groupBy(key, filled.alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    pair = F.struct("_value", "_n")
    return counts.groupBy(key).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(pair)),
        lambda p: F.concat(p["_value"], F.lit(":"), p["_n"].cast("string"))), "|").alias(name))


def unit_census(denominators: DataFrame, localities: DataFrame,
                capabilities: DataFrame) -> DataFrame:
    """Enumerated units and histograms of levels, units, capabilities and platforms (A5)."""
    n = localities.groupBy("state").agg(F.count(F.lit(1)).alias("enumerated_primary_units"))
    out = denominators.select("state", "expected_primary_units").join(n, "state", "left")
    parts = [(localities, "jurisdiction_level", "administrative_levels"),
             (capabilities, "smallest_observed_unit", "observed_reporting_units"),
             (capabilities, "capability_type", "capability_types"),
             (capabilities, "platform_family", "data_access_families")]
    for rows, column, name in parts:
        out = out.join(histogram(rows, "state", column, name), "state", "left")
    return out.fillna(0, ["enumerated_primary_units"]).fillna("none", [p[2] for p in parts])


def link_candidates(rows: DataFrame, order: str) -> DataFrame:
    """Result links of authority rows, one per state and URL, with family and tier."""
    links = rows.select("*", F.explode(split_links(F.col("result_links"))).alias("result_url"))
    links = links.withColumn("state", F.upper("state"))
    first = links.groupBy("state", "result_url").agg(F.min_by(F.struct(
        "authority_url", "election_night_candidate", "smallest_observed_unit"), order).alias("r"))
    out = first.withColumn("access_family", C.result_family(F.col("result_url"), F.lit("")))
    return out.select(
        "state", "result_url", U.host(F.col("result_url")).alias("result_host"), "access_family",
        C.ingest_tier(F.col("access_family"), F.col("result_url")).alias("ingest_tier"),
        "r.authority_url", "r.election_night_candidate",
        F.coalesce(first_present(F.col("r.smallest_observed_unit")), F.lit("unknown"))
        .alias("smallest_observed_unit"))


def family_summary(candidates: DataFrame, denominators: DataFrame) -> DataFrame:
    """Candidates and exposed units per tier and family, in tier order."""
    keys = ["ingest_tier", "access_family"]
    n = candidates.groupBy(*keys).agg(F.count(F.lit(1)).alias("unique_result_urls"))
    states = candidates.select(*keys, "state").distinct().join(
        denominators.select("state", "expected_primary_units"), "state", "left")
    exposed = states.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_set("state")), "|").alias("states"),
        F.count_distinct("state").alias("state_count"),
        F.coalesce(F.sum("expected_primary_units"), F.lit(0)).alias("expected_units_exposed"))
    return n.join(exposed, keys).orderBy(
        C.tier_rank(F.col("ingest_tier")), F.col("expected_units_exposed").desc(),
        "access_family")


def supported_manifest(candidates: DataFrame) -> DataFrame:
    """Candidates the parsers can read today."""
    parser = C.supported_parser(F.col("ingest_tier"), F.col("access_family"),
                                F.col("result_url"))
    return candidates.withColumn("parser", parser).filter("parser is not null").select(
        "state", "result_url", "access_family", "parser", "smallest_observed_unit",
        F.lit("supported_unverified").alias("status"))


def stage_ordinal(stage: Column) -> Column:
    """1 to 7 along the execution ladder, 0 when unknown."""
    return F.array_position(F.array(*[F.lit(s) for s in C.STAGES]), F.lower(stage))


def depth_summary(rows: DataFrame, key: str = "state") -> DataFrame:
    """Highest stage and counts at or above the ladder's marks."""
    o = F.col("_o")
    out = rows.withColumn("_o", stage_ordinal(F.col("execution_stage"))).groupBy(key).agg(
        F.count(F.lit(1)).alias("sources_attempted"),
        F.count_if(F.coalesce("failure_class", F.lit("")) != "").alias("failures"),
        F.count_if(o >= 3).alias("parser_selected_or_higher"),
        F.count_if(o >= 5).alias("normalized_or_higher"),
        F.count_if(o >= 6).alias("replay_tested_or_higher"),
        F.count_if(o == 7).alias("refresh_verified"),
        F.greatest(F.max(o), F.lit(1)).alias("_top"))
    ladder = F.array(*[F.lit(s) for s in C.STAGES])
    return out.withColumn("highest_execution_stage",
                          F.element_at(ladder, F.col("_top").cast("int"))).drop("_top")


def residual_summary(rows: DataFrame) -> DataFrame:
    """Unfinished work by residual class and family, most urgent first."""
    kind = C.residual_class(F.col("failure_class"), F.col("execution_stage"),
                            F.col("access_family"))
    out = rows.groupBy(kind.alias("residual_class"), "access_family").agg(
        F.count(F.lit(1)).alias("source_count"))
    return out.withColumn("priority", C.residual_priority(F.col("residual_class"))).orderBy(
        F.col("priority").desc(), F.col("source_count").desc(), "residual_class", "access_family")


def readiness_summary(rows: DataFrame) -> DataFrame:
    """Sources by next action."""
    action = C.next_action(F.col("fetch_status"), F.col("platform_family"),
                           F.col("discovered_artifacts"))
    return rows.groupBy(action.alias("next_action")).agg(F.count(F.lit(1)).alias("source_count"))


def host_priority(candidates: DataFrame, order: str) -> DataFrame:
    """Unsupported hosts by night candidates and size, with a sample URL."""
    night = F.lower("election_night_candidate") == "true"
    return candidates.groupBy("result_host").agg(
        F.count(F.lit(1)).alias("candidate_count"),
        F.array_join(F.array_sort(F.collect_set("state")), "|").alias("states"),
        F.count_if(night).alias("election_night_candidate_count"),
        F.min_by("result_url", order).alias("sample_url"),
    ).orderBy(F.col("election_night_candidate_count").desc(), F.col("candidate_count").desc(),
              "result_host")


def near_ready(candidates: DataFrame) -> DataFrame:
    """Candidates one adapter short, with their blocker."""
    return candidates.filter("ingest_tier = 'needs_adapter_completion'").withColumn(
        "promotion_blocker", C.promotion_blocker(F.col("access_family"), F.col("result_url")))


def promotion_summary(rows: DataFrame, states: DataFrame, order: str) -> DataFrame:
    """Reached surfaces of each listed state; states without any keep zeros (A10)."""
    url, host = F.trim("authority_url"), F.lower(F.trim("authority_host"))
    usable = rows.filter((F.col("status") == "reached") & (url != "") & (host != ""))
    first = usable.groupBy("state", url.alias("_url")).agg(F.min_by(F.struct(
        "result_links", "election_night_candidate", "smallest_observed_unit"), order).alias("r"))
    counts = first.groupBy("state").agg(
        F.count(F.lit(1)).alias("reached_surfaces"),
        F.count_if(F.trim(F.coalesce("r.result_links", F.lit(""))) != "")
        .alias("surfaces_with_result_links"),
        F.count_if(F.lower("r.election_night_candidate") == "true")
        .alias("election_night_candidates"),
        F.count_if(F.col("r.smallest_observed_unit").isin(FINE_UNITS))
        .alias("precinct_or_finer_surfaces"))
    return states.join(counts, "state", "left").fillna(0)


def readiness(denominators: DataFrame, localities: DataFrame, starts: DataFrame,
              leads: DataFrame, verified: DataFrame, central: DataFrame) -> DataFrame:
    """Named, unnamed, started and verified units per state with national sums.

    ``starts``, ``leads`` and ``verified`` are tables of unit ids; ``central`` lists states with
    a directory.
    """
    def flag(df: DataFrame, name: str) -> DataFrame:
        return df.select("jurisdiction_id").distinct().withColumn(name, F.lit(True))

    units = localities.select("jurisdiction_id", "state")
    for df, name in ((starts, "direct"), (leads, "lead"), (verified, "verified")):
        units = units.join(flag(df, name), "jurisdiction_id", "left")
    units = units.join(central.select("state").distinct().withColumn("central", F.lit(True)),
                       "state", "left").fillna(False)
    candidate = F.col("direct") | F.col("lead")
    counts = units.groupBy("state").agg(
        F.count_distinct("jurisdiction_id").alias("named_units"),
        F.count_if(F.col("direct") | F.col("central")).alias("units_with_any_start"),
        F.count_if("direct").alias("units_with_direct_evidence"),
        F.count_if("lead").alias("units_with_search_candidates"),
        F.count_if(candidate).alias("units_with_any_direct_candidate"),
        F.count_if((F.col("direct") | F.col("central")) & ~candidate)
        .alias("fallback_only_units"),
        F.count_if("verified").alias("verified_units"))
    out = denominators.select("state", "expected_primary_units", "estimate_status").join(
        counts, "state", "left")
    out = out.fillna(0).withColumn(
        "unnamed_units", F.greatest(F.lit(0), F.col("expected_primary_units")
                                    - F.col("named_units"))
    ).withColumn("denominator_overrun", F.greatest(
        F.lit(0), F.col("named_units") - F.col("expected_primary_units")))
    sums = [c for c in out.columns if c not in ("state", "estimate_status")]
    total = out.agg(F.lit("US").alias("state"), *[F.sum(c).alias(c) for c in sums],
                    F.when(F.count_if(F.col("estimate_status") != "high_confidence") > 0,
                           "provisional").otherwise("high_confidence").alias("estimate_status"))
    return out.withColumn("state", F.col("state").cast("string")).unionByName(total)


def start_audit(denominators: DataFrame, localities: DataFrame, starts: DataFrame) -> DataFrame:
    """Start coverage per state and whether it is complete."""
    own = F.col("page_role") != "state_directory_fallback"
    have = starts.groupBy("jurisdiction_id").agg(F.bool_or(own).alias("own"))
    units = localities.select("jurisdiction_id", "state").join(have, "jurisdiction_id", "left")
    counts = units.groupBy("state").agg(
        F.count_distinct("jurisdiction_id").alias("named_units"),
        F.count_if(F.col("own").isNotNull()).alias("units_with_any_start"),
        F.count_if(F.coalesce("own", F.lit(False))).alias("units_with_direct_lead"))
    out = denominators.select("state", "expected_primary_units", "estimate_status").join(
        counts, "state", "left").fillna(0)
    named, expected = F.col("named_units"), F.col("expected_primary_units")
    return out.withColumns({
        "unnamed_units": F.greatest(F.lit(0), expected - named),
        "named_units_without_start": named - F.col("units_with_any_start"),
        "complete": (named == expected) & (named == F.col("units_with_any_start"))
        & (F.col("estimate_status") == "high_confidence")})


def portability_shares(rows: DataFrame) -> DataFrame:
    """Class counts and reusable shares."""
    counts = [F.count_if(F.col("portability_class") == c).alias(c) for c in "ABCDE"]
    out = rows.agg(F.count(F.lit(1)).alias("counties"), *counts)
    n = F.nullif(F.col("counties"), F.lit(0))
    return out.withColumns({
        "a_or_b_share": F.coalesce((F.col("A") + F.col("B")) / n, F.lit(0.0)),
        "a_b_or_c_share": F.coalesce((F.col("A") + F.col("B") + F.col("C")) / n, F.lit(0.0))})


def column_inventory(rows: DataFrame, label: str, vote_columns: list[str]) -> DataFrame:
    """Rows, distinct labels and the vote columns present."""
    present = [c for c in vote_columns if c in [x.strip().lower() for x in rows.columns]]
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(first_present(F.col(label))).alias("distinct_labels"),
        F.lit("|".join(present)).alias("vote_columns"))


def precinct_column(columns: list[str]) -> str | None:
    """First known unit column of a header, whatever its case."""
    lowered = {c.lower(): c for c in columns}
    return next((lowered[c] for c in PRECINCT_COLUMNS if c in lowered), None)


def observed_units(rows: DataFrame, county: str, label: str, source: str,
                   election: str) -> DataFrame:
    """Distinct observed unit labels with a stable id."""
    out = rows.select(F.trim(F.coalesce(county, F.lit(""))).alias("county"),
                      F.trim(F.col(label)).alias("raw_label")).filter("raw_label <> ''").distinct()
    return out.withColumn("observed_reporting_unit_id", stable_observation_id(
        F.lit(source), F.lit(election), F.col("county"), F.col("raw_label")))


def modes_preserved(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Whether a source keeps vote modes apart."""
    raw = F.coalesce("raw_vote_mode", F.lit(""))
    return facts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("observation_count"),
        F.bool_or(~raw.isin("", "total", "votes")).alias("vote_modes_preserved"))


def geography_ledger(localities: DataFrame) -> DataFrame:
    """Source count, search state and search text per unit."""
    def has(c: str) -> Column:
        return (F.coalesce(c, F.lit("")) != "").cast("int")
    n = has("final_evidence_url") + has("election_night_evidence_url")
    return localities.select(
        "jurisdiction_id", "state", n.alias("source_count"),
        F.when(n > 0, "resolved").otherwise("unresolved").alias("search_status"),
        F.concat_ws(" ", "canonical_name", "state", F.lit("election results"))
        .alias("search_query"))


def source_leads(localities: DataFrame) -> DataFrame:
    """One lead per unit, URL and role from the two evidence columns."""
    pair = F.array(
        F.struct(F.col("final_evidence_url").alias("lead_url"), F.lit("final").alias("source_role")),
        F.struct(F.col("election_night_evidence_url").alias("lead_url"),
                 F.lit("election_night").alias("source_role")))
    return localities.select("jurisdiction_id", "state", F.inline(pair)).filter(
        "coalesce(lead_url, '') <> ''").distinct()


def state_gaps(rows: DataFrame, census: DataFrame) -> DataFrame:
    """Coverage phase per state with its platform families, most frequent first."""
    family = F.coalesce(first_present(F.col("platform_family")), F.lit("unclassified"))
    families = rows.groupBy("state", family.alias("f")).agg(F.count(F.lit(1)).alias("n"))
    families = families.groupBy("state").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "f"))),
        lambda p: F.concat(p["f"], F.lit(":"), (-p["m"]).cast("string"))), "|")
        .alias("discovered_families"))
    counts = rows.groupBy("state").agg(
        F.count(F.lit(1)).alias("discovered_rows"),
        F.count_if(F.col("status") == "reached").alias("reached_authorities"),
        F.count_if(F.coalesce("result_links", F.lit("")) != "").alias("rows_with_result_links"),
        F.count_if(F.lower("election_night_candidate") == "true")
        .alias("election_night_candidates"))
    out = counts.join(families, "state", "left").join(
        census.select("state", "expected_primary_units", "enumerated_primary_units"), "state",
        "full").fillna(0).fillna("", ["discovered_families"])
    return out.withColumn("phase", C.state_phase(
        F.col("enumerated_primary_units"), F.col("reached_authorities"),
        F.col("rows_with_result_links")))


def pending_buckets(rows: DataFrame) -> DataFrame:
    """Pending cases by what is missing."""
    status = F.lower(F.coalesce("authority_status", F.lit("")))
    bucket = (
        F.when(status.contains("fetch") | status.contains("failed"), "authority_fetch_failed")
        .when(F.coalesce("authority_url", F.lit("")) == "", "authority_unresolved")
        .when(F.coalesce("artifact_url", F.lit("")) == "",
              "authority_resolved_no_result_artifact")
        .otherwise("artifact_needs_followup")
    )
    return rows.filter("portability = 'pending'").groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("cases"))


# Statuses of the corpora compared by the gap matrix.
CORPUS_OFFICIAL = ["direct_official_url", "official_social_reference", "official_file_share",
                   "official_dashboard_candidate"]
CORPUS_SECONDARY = ["secondary_source", "secondary_or_manual_collection",
                    "local_official_sources_aggregate",
                    "derived_local_dataset_no_source_pointer"]
CITED_SECONDARY = ["secondary_repository", "secondary_source"]


def corpus_gaps(harvest: DataFrame, archive: DataFrame, cited: DataFrame, scraped: DataFrame,
                own: DataFrame) -> DataFrame:
    """Official candidates, reasons and priority per state over five corpora.

    ``harvest`` (state, source_url, harvest_status, lead_count) drives; ``archive`` and ``cited``
    carry source_class; ``scraped`` lists states; ``own`` has result_url.
    """
    rows = (
        harvest.join(archive.select("state", F.col("source_class").alias("_a")), "state", "left")
        .join(cited.select("state", F.col("source_class").alias("_c")), "state", "left")
        .join(scraped.select("state").distinct().withColumn("_s", F.lit(1)), "state", "left")
        .join(own.select("state", F.col("result_url").alias("_o")), "state", "left"))

    def one(test: Column) -> Column:
        return F.when(test, 1).otherwise(0)

    archive_ok = F.col("_a") == "official_candidate"
    n = (
        F.when(F.col("harvest_status").isin(CORPUS_OFFICIAL),
               F.greatest(F.lit(1), F.coalesce("lead_count", F.lit(0)))).otherwise(0)
        + one(archive_ok) + one(F.col("_c") == "official_candidate")
        + one(F.col("_s").isNotNull()) + one(F.coalesce("_o", F.lit("")) != ""))
    rows = rows.withColumn("official_candidate_count", n.cast("long"))
    none = F.col("official_candidate_count") == 0
    not_archive = ~F.coalesce(archive_ok, F.lit(False))
    secondary = none & (F.col("harvest_status").isin(CORPUS_SECONDARY) | not_archive
                        | F.coalesce(F.col("_c").isin(CITED_SECONDARY), F.lit(False)))
    no_url = F.coalesce("source_url", F.lit("")) == ""
    no_link = F.coalesce(F.col("_c") == "no_direct_source_link", F.lit(False))
    reasons = F.array_compact(F.array(
        F.when(no_url, F.lit("harvest_no_url")),
        F.when(not_archive, F.lit("archive_nonprimary")),
        F.when(no_link, F.lit("cited_no_direct_link"))
        .when(F.col("_c").isin(CITED_SECONDARY), F.lit("cited_secondary")),
        F.when(F.col("_s").isNull(), F.lit("no_live_scraper")),
        F.when(secondary, F.lit("secondary_only"))))
    priority = (F.when(none, 3).otherwise(0) + F.when(secondary, 2).otherwise(0)
                + one(no_url) + one(no_link))
    return rows.select(
        "state", "official_candidate_count", secondary.alias("secondary_only"),
        priority.cast("long").alias("gap_priority"),
        F.when(F.size(reasons) > 0, F.array_join(reasons, ";")).otherwise("none")
        .alias("gap_reasons"))


def depth_matrix(surfaces: DataFrame, denominators: DataFrame, localities: DataFrame,
                 leads: DataFrame, execution: DataFrame) -> DataFrame:
    """Within-state depth of coverage with reasons and priority.

    Every side is aggregated to one row per state before the joins.
    """
    loc = localities.groupBy("state").agg(F.count_distinct("jurisdiction_id").alias("enumerated"))
    lead = leads.groupBy("state").agg(F.count_distinct("jurisdiction_id").alias("with_lead"),
                                      F.count(F.lit(1)).alias("lead_rows"))
    o = stage_ordinal(F.col("stage"))
    ex = execution.groupBy("state").agg(
        F.count(F.lit(1)).alias("execution_rows"), F.count_if(o >= 3).alias("executable"),
        F.count_if(o >= 5).alias("normalized"), F.count_if(o >= 6).alias("replay_tested"),
        F.count_if(o >= 7).alias("refresh_verified"), F.max(o).alias("_top"))
    rows = surfaces.join(denominators.select("state", F.col("expected_primary_units")
                                             .alias("expected")), "state", "left")
    for side in (loc, lead, ex):
        rows = rows.join(side, "state", "left")
    rows = rows.fillna(0)
    night = F.lower("election_night_candidate") == "true"
    short = (F.col("expected") > 0) & (F.col("enumerated") < F.col("expected"))
    few = (F.col("enumerated") > 0) & (F.col("with_lead") < F.col("enumerated"))
    none = F.col("normalized") == 0
    reasons = F.array_compact(F.array(
        F.when(short, F.lit("enumeration_gap")), F.when(few, F.lit("source_lead_gap")),
        F.when(F.col("execution_rows") == 0, F.lit("no_execution_evidence")),
        F.when(none, F.lit("no_normalized_execution")),
        F.when(night & (F.col("refresh_verified") == 0),
               F.lit("election_night_refresh_unverified"))))

    def points(test: Column, n: int) -> Column:
        return F.when(test, n).otherwise(0)

    ladder = F.array(*[F.lit(s) for s in C.STAGES])
    return rows.select(
        "state", "expected", "enumerated", "with_lead", "lead_rows",
        (F.col("enumerated") / F.nullif(F.col("expected"), F.lit(0))).alias("enumeration_ratio"),
        (F.col("with_lead") / F.nullif(F.col("enumerated"), F.lit(0))).alias("lead_ratio"),
        "execution_rows", "executable", "normalized", "replay_tested", "refresh_verified",
        F.element_at(ladder, F.greatest(F.col("_top"), F.lit(1)).cast("int"))
        .alias("highest_stage"),
        (points(night, 3) + points(short, 2) + points(few, 2) + points(none, 2)).cast("long")
        .alias("depth_priority"),
        F.when(F.size(reasons) > 0, F.array_join(reasons, ";")).otherwise("baseline_satisfied")
        .alias("depth_reasons"))


def blended_score(sources: DataFrame, population: str, units: str, national_population: Column,
                  national_units: Column, weights: tuple[float, ...] = (0.5, 0.4, 0.6)
                  ) -> DataFrame:
    """Blend of population and unit gains, each over its national total.

    The first weight is the planning value; the others are the sensitivity checks.
    """
    p = F.col(population) / national_population
    u = F.col(units) / national_units
    out = sources.withColumn("population_gain", p).withColumn("unit_gain", u)
    for w in weights:
        out = out.withColumn(f"score_{round(w * 100)}", w * p + (1 - w) * u)
    return out


def visibility_proxy(population: Column) -> Column:
    """Cube-root estimate of visible units; null population stays unknown."""
    return F.when(population > 0, F.greatest(
        F.lit(1), F.bround(F.cbrt(population.cast("double")) / 10).cast("long")))


def visibility_band(population: Column) -> Column:
    """Typical visible units with lower and upper scenario bounds."""
    p = population.cast("double") / 10_000
    typical = F.greatest(F.lit(1), F.bround(2 * F.pow(p, F.lit(0.55))).cast("long"))
    spread = 0.35 + 0.20 * F.greatest(F.lit(0.0), F.log10(p))
    lower = F.greatest(F.lit(1), F.bround(typical * F.exp(-1.645 * spread)).cast("long"))
    upper = F.greatest(typical, F.bround(typical * F.exp(1.645 * spread)).cast("long"))
    return F.when(population > 0, F.struct(typical.alias("typical"), lower.alias("lower"),
                                           upper.alias("upper")))


RESOLUTIONS = {"any": 1, "municipality_or_finer": 2, "precinct_or_finer": 3}


def covered_population(places: DataFrame, sources: DataFrame) -> DataFrame:
    """Population covered at three resolutions, counted once per place.

    ``sources`` has place and resolution rank (null unknown). A place counts at a threshold when
    its finest known source reaches it; places with only unknown sources are kept apart.
    """
    best = sources.groupBy("place").agg(F.max("resolution").alias("best"))
    rows = places.join(best, "place", "left").join(
        sources.select("place").distinct().withColumn("listed", F.lit(True)), "place", "left")
    return rows.agg(
        *[F.coalesce(F.sum(F.when(F.col("best") >= r, F.col("population"))), F.lit(0)).alias(n)
          for n, r in RESOLUTIONS.items()],
        F.coalesce(F.sum(F.when(F.col("listed") & F.col("best").isNull(),
                                F.col("population"))), F.lit(0)).alias("unknown_resolution"),
        F.sum("population").alias("total"))


def assurance_packet(checks: DataFrame, keys: list[str]) -> DataFrame:
    """Status and evidence coverage from the results of single checks.

    ``checks`` has check, status (pass, fail or underpowered). Missing evidence never passes.
    """
    out = checks.groupBy(*keys).agg(
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "fail").alias("material_unresolved_discrepancies"),
        F.array_sort(F.collect_set(F.when(F.col("status") == "underpowered", F.col("check"))))
        .alias("underpowered_checks"))
    status = (
        F.when(F.col("material_unresolved_discrepancies") > 0, "material_discrepancy")
        .when(F.col("passed") > 0, "consistent_with_observed_evidence")
        .otherwise("insufficient_evidence")
    )
    return out.withColumn("status", status)


def swing_residuals(units: DataFrame, before: str, after: str, levels: list[str]) -> DataFrame:
    """Each unit's change less the uniform change of its groups.

    The national mean and the mean of every level are computed by aggregates and joined back.
    """
    swing = F.col(after) - F.col(before)
    rows = units.withColumn("swing", swing)
    nation = rows.agg(F.avg("swing").alias("_national"))
    # One row: the national mean.
    out = rows.join(F.broadcast(nation)).withColumn(
        "residual_national", F.col("swing") - F.col("_national")).drop("_national")
    for level in levels:
        mean = rows.groupBy(level).agg(F.avg("swing").alias("_mean"))
        out = out.join(mean, level).withColumn(
            f"residual_{level}", F.col("swing") - F.col("_mean")).drop("_mean")
    return out
