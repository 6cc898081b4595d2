"""Data-quality rules as violation tables ``(rule_id, key..., detail)``.

Strict callers raise when a table is not empty; the table keeps every finding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import ids
from tallyweave.functions import urls as U
from tallyweave.functions.values import first_present
from tallyweave.operators.intervals import inverted
from tallyweave.session import bind

SHA256 = "^[0-9a-fA-F]{64}$"
LOWER_SHA256 = "^[0-9a-f]{64}$"


def _blank(column: str) -> Column:
    return F.trim(F.coalesce(F.col(column).cast("string"), F.lit(""))) == ""


def violations(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """One row per broken rule and input row."""
    found = F.array_compact(F.array(*[
        F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()]))
    return df.select(*keys, F.explode(found).alias("rule_id"))


def first_violation(rules: dict[str, Column]) -> Column:
    """Name of the first broken rule in order, else null."""
    return F.coalesce(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name))
                        for name, test in rules.items()])


def require_clean(found: DataFrame, shown: int = 5) -> None:
    """Raise when there are violations (strict mode)."""
    rows = found.take(shown)
    if rows:
        raise ValueError(f"violations: {[r.asDict() for r in rows]}")


def progress_rules() -> dict[str, Column]:
    """Shape of progress rows (V1)."""
    scope, kind = F.col("scope"), F.col("kind")
    unit, contest = ~_blank("reporting_unit_id"), ~_blank("contest_id")
    has = lambda c: F.col(c).isNotNull()
    counts = has("reporting_count") | has("expected_count")
    units = kind.isin("unit_exists", "unit_reported")
    parts = kind == "expected_components"
    twice = lambda c: F.size(c) != F.size(F.array_distinct(c))
    return {
        "unit_scope_needs_unit": (scope == "reporting_unit") & ~unit,
        "source_scope_with_unit": (scope == "source") & has("reporting_unit_id"),
        "contest_scope_needs_contest": (scope == "contest") & ~contest,
        "contest_scope_with_unit": (scope == "contest") & has("reporting_unit_id"),
        "contest_outside_contest_scope": (scope != "contest") & has("contest_id"),
        "negative_reporting_count": F.col("reporting_count") < 0,
        "negative_expected_count": F.col("expected_count") < 0,
        "counts_missing": (kind == "source_counts") & ~counts,
        "counts_on_other_kind": (kind != "source_counts") & counts,
        "complete_missing": (kind == "source_complete") & ~has("complete"),
        "complete_on_other_kind": (kind != "source_complete") & has("complete"),
        "reported_missing": units & ~has("reported"),
        "reported_on_other_kind": ~units & has("reported"),
        "components_missing": parts & ~has("expected_components"),
        "components_repeat": parts & (twice("expected_components")
                                      | F.coalesce(twice("observed_components"), F.lit(False))),
        "components_on_other_kind": ~parts & (has("expected_components")
                                              | has("observed_components")),
        "snapshot_not_sha256": has("snapshot_sha256") & ~F.col("snapshot_sha256").rlike(SHA256),
        "completion_without_status": (F.col("basis") == "source_reported")
        & ~has("raw_status") & (kind == "source_complete"),
    }


def topology_rules() -> dict[str, Column]:
    """Canonical topology needs regime, snapshot and canonical jurisdiction (V2)."""
    topology = (F.col("reporting_regime_id").isNotNull()
                | F.col("reporting_unit_raw_name").isNotNull()
                | F.col("reporting_unit_source_native_id").isNotNull())
    return {
        "topology_without_regime": topology & _blank("reporting_regime_id"),
        "topology_without_snapshot": topology & ~F.coalesce(
            F.col("snapshot_sha256").rlike(SHA256), F.lit(False)),
        "topology_without_canonical_jurisdiction": topology
        & ~F.col("jurisdiction_id").startswith("us:"),
    }


def snapshot_rules(need_body: bool = True) -> dict[str, Column]:
    """Snapshot hash and body presence (V3)."""
    rules = {"bad_sha256": ~F.coalesce(F.col("sha256").rlike(LOWER_SHA256), F.lit(False))}
    if need_body:
        rules["missing_body"] = _blank("body_path")
    return rules


def missing_provenance(records: DataFrame, snapshots: DataFrame) -> DataFrame:
    """All records without a landed snapshot of their own source (V3)."""
    known = snapshots.select("source_id", F.col("sha256").alias("snapshot_sha256")).distinct()
    return records.join(known, ["source_id", "snapshot_sha256"], "left_anti")


def attach_snapshot(records: DataFrame, source_id: str, sha256: str) -> tuple[
        DataFrame, DataFrame]:
    """Records stamped with a snapshot, and those of another source (V3)."""
    same = F.col("source_id") == source_id
    return (records.filter(same).withColumn("snapshot_sha256", F.lit(sha256)),
            records.filter(~same))


def wide_payload_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Strict reading of wide rows (V4): incomplete rows, missing or non-integer counts."""
    from tallyweave.sources.results import COLUMN_ALIASES, VOTE_COLUMNS, _header
    header = _header(df)

    def has(field: str) -> Column:
        return first_present(*[F.col(f"`{header[a]}`") for a in COLUMN_ALIASES[field]
                               if a in header]).isNotNull()

    votes = F.filter(F.array(*[F.col(f"`{header[c]}`").cast("string") for c in VOTE_COLUMNS
                               if c in header]),
                     lambda v: v.isNotNull() & (v != ""))
    any_value = F.exists(F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns]),
                         lambda v: F.coalesce(v, F.lit("")) != "")
    rows = bind(df, _votes=votes, _any=any_value)
    incomplete = ~(has("precinct") & has("contest") & has("candidate"))
    return violations(rows.filter("_any"), keys, {
        "incomplete_row": incomplete,
        "missing_votes": F.size("_votes") == 0,
        "votes_not_integer": F.exists("_votes", lambda v: ~F.trim(v).rlike("^-?[0-9][0-9,]*$")),
    })


def json_payload_violations(df: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """Strict reading of unit, contest, choice documents (V4), one row per document and rule.

    A body that is null, no JSON or of another shape has an unsupported schema.
    """
    from tallyweave.sources.results import NESTED_JSON, whole_votes

    def each(items: str | Column, test) -> Column:
        return F.coalesce(F.exists(items, test), F.lit(False))

    units = F.col("_d.reporting_units")
    contests = F.flatten(F.transform(F.filter(units, lambda u: u.contests.isNotNull()),
                                     lambda u: u.contests))
    rows = bind(df, _d=F.from_json(body, NESTED_JSON))
    rows = bind(rows, _contests=contests)
    choices = F.flatten(F.transform(F.filter("_contests", lambda c: c.choices.isNotNull()),
                                    lambda c: c.choices))
    rows = bind(rows, _choices=choices)
    return violations(rows, keys, {
        "unsupported_schema": units.isNull(),
        "invalid_unit": each(units, lambda u: u.contests.isNull()),
        "invalid_contest": each("_contests", lambda c: c.choices.isNull()),
        "invalid_choice": each("_choices", lambda h: h.isNull()),
        "votes_not_integer": each("_choices", lambda h: h.isNotNull() & ~whole_votes(h.votes)),
    })


def capture_rules(body: str, required_text: Column) -> dict[str, Column]:
    """A capture must carry its marker text (V5)."""
    return {"marker_absent": ~F.col(body).contains(required_text)}


def observation_rules() -> dict[str, Column]:
    """Absolute counts are never negative (V5)."""
    return {"negative_votes": F.col("votes") < 0}


def capability_rules() -> dict[str, Column]:
    """Capability rows (V6, V7)."""
    digest = F.lower(F.coalesce("evidence_snapshot_sha256", F.lit("")))
    return {
        "jurisdiction_not_canonical": ~F.col("jurisdiction_id").startswith("us:"),
        "authority_not_independent": ~F.col("authority_id").startswith("us:authority:"),
        "source_missing": _blank("source_id"),
        "method_missing": _blank("assessment_method"),
        "bad_digest": (digest != "") & ~digest.rlike(LOWER_SHA256),
        "inverted_interval": inverted("valid_from", "valid_to"),
        "no_evidence": (digest == "") & _blank("evidence_reference"),
    }


def alias_rules() -> dict[str, Column]:
    """Identity alias rows (V7)."""
    return {
        "identity_fields_missing": _blank("canonical_id") | _blank("alias_value")
        | _blank("alias_namespace"),
        "confidence_out_of_range": ~F.col("confidence").between(0, 1),
        "evidence_missing": _blank("reconciliation_method") | _blank("evidence_reference"),
        "verified_without_reviewer": (F.col("status") == "verified") & _blank("reviewer"),
        "inverted_interval": inverted("effective_from", "effective_to"),
    }


def bridge_rules() -> dict[str, Column]:
    """Authority to jurisdiction bridges (V7)."""
    return {
        "authority_not_independent": ~F.col("authority_id").startswith("us:authority:"),
        "jurisdiction_not_canonical": ~F.col("jurisdiction_id").startswith("us:"),
        "inverted_interval": inverted("effective_from", "effective_to"),
    }


def unit_crosswalk_rules() -> dict[str, Column]:
    """Weighted edges between units (V8)."""
    return {
        "self_edge": F.col("from_reporting_unit_id") == F.col("to_reporting_unit_id"),
        "bad_evidence_digest": ~F.coalesce(F.col("evidence_snapshot_sha256").rlike(SHA256),
                                           F.lit(False)),
        "weight_out_of_range": ~F.col("weight").between(0, 1),
        "weight_without_basis": F.col("weight").isNotNull() & _blank("weight_basis"),
        "inverted_interval": inverted("effective_from", "effective_to"),
    }


def geo_crosswalk_rules() -> dict[str, Column]:
    """Edges from units to geography (V8)."""
    synthetic = F.col("relationship_type") == "synthetic_non_geographic"
    weighted = F.col("allocation_weight").isNotNull()
    unmapped = F.col("unmapped_weight").isNotNull()
    return {
        "non_geographic_with_geography": synthetic & ~_blank("geographic_unit_id"),
        "geography_missing": ~synthetic & _blank("geographic_unit_id"),
        "bad_evidence_digest": ~F.coalesce(F.col("evidence_snapshot_sha256").rlike(SHA256),
                                           F.lit(False)),
        "weight_out_of_range": weighted & ~F.col("allocation_weight").between(0, 1),
        "weight_without_basis": weighted & _blank("weight_basis"),
        "weight_on_exact": weighted & F.col("relationship_type").isin(
            "exact", "synthetic_non_geographic"),
        "unmapped_out_of_range": unmapped & ~F.col("unmapped_weight").between(0, 1),
        "unmapped_without_basis": unmapped & _blank("unmapped_basis"),
        "unmapped_needs_partial": unmapped & (F.col("allocation_coverage") != "partial"),
        "complete_with_unmapped": (F.col("allocation_coverage") == "complete")
        & (F.coalesce("unmapped_weight", F.lit(0.0)) != 0),
        "inverted_interval": inverted("effective_from", "effective_to"),
    }


def edge_rules() -> dict[str, Column]:
    """Geography edges (V9): containment alone is never additive."""
    return {
        "self_edge": F.col("parent_id") == F.col("child_id"),
        "containment_marked_additive": F.col("relation").isin("contains", "overlaps")
        & F.col("additive").eqNullSafe(True),
    }


def locality_rules() -> dict[str, Column]:
    """Coverage status against capability flags."""
    flags = F.struct("final_capable", "election_night_capable")

    def pair(a: bool, b: bool) -> Column:
        return F.struct(F.lit(a).alias("final_capable"), F.lit(b).alias("election_night_capable"))

    status = F.col("coverage_status")
    expected = (F.when(status == "enumerated_unresolved", pair(False, False))
                .when(status == "final_only", pair(True, False))
                .when(status == "election_night_only", pair(False, True))
                .when(status == "both", pair(True, True)))
    missing = status == "known_missing_source"
    return {
        "jurisdiction_not_canonical": ~F.col("jurisdiction_id").startswith("us:"),
        "authority_not_independent": ~_blank("authority_id")
        & ~F.col("authority_id").startswith("us:authority:"),
        "status_disagrees_with_flags": expected.isNotNull() & (expected != flags),
        "missing_source_is_capable": missing & (F.col("final_capable")
                                                | F.col("election_night_capable")),
        "missing_source_not_adjudicated": missing & (
            (F.coalesce("assessment_status", F.lit("")) != "affirmatively_adjudicated")
            | _blank("assessment_method")),
    }


def evidence_rules() -> dict[str, Column]:
    """Execution evidence against its stage, 1 to 7."""
    stage = F.col("stage")
    return {
        "normalized_without_rows": (stage >= 5) & (F.col("observation_count") <= 0),
        "replay_without_snapshot": (stage >= 6) & _blank("snapshot_sha256"),
        "normalized_with_failure": (stage >= 5) & ~_blank("failure_class"),
    }


def promotable(evidence: DataFrame) -> DataFrame:
    """Clean evidence whose normalization really ran."""
    return evidence.filter((F.col("stage") >= 5) & first_violation(evidence_rules()).isNull())


def lead_rules() -> dict[str, Column]:
    """External leads."""
    return {
        "record_id_missing": _blank("source_record_id"),
        "url_not_http": ~F.col("lead_url").rlike("^https?://"),
        "verified_without_notes": (F.col("official_status") == "verified_official")
        & F.col("origin").isin("research_repository", "scraper_repository") & _blank("notes"),
    }


def feed_rules() -> dict[str, Column]:
    """One feed of a manifest."""
    return {
        "staleness_below_interval": F.col("stale_after_seconds") < F.col("interval_seconds"),
        "enabled_without_review": F.col("enabled") & (_blank("evidence_url")
                                                      | _blank("reviewed_at")),
        "unknown_parser": ~F.col("parser").isin(
            "nested_json", "nested_xml", "script_json", "heading_page", "wide_csv"),
    }


def feed_identity(columns: list[str]) -> Column:
    """Digest of a feed's configuration; a change resets its state."""
    return ids.canonical_json_digest(*columns)


def manifest_violations(feeds: DataFrame) -> DataFrame:
    """Feed rules plus unique source ids and one election."""
    own = violations(feeds, ["source_id"], feed_rules())
    twice = feeds.groupBy("source_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
        "source_id", F.lit("duplicate_source").alias("rule_id"))
    elections = feeds.agg(F.min("election_id").alias("_a"), F.max("election_id").alias("_b"))
    mixed = elections.filter("_a <> _b").select(
        F.lit(None).cast("string").alias("source_id"), F.lit("several_elections").alias("rule_id"))
    return own.unionByName(twice).unionByName(mixed)


def regime_rules() -> dict[str, Column]:
    """Reporting regime against the source's capability."""
    kind, capability = F.col("regime_kind"), F.col("capability_type")
    return {
        "capability_not_positive": ~F.col("verification_status").isin(
            "verified", "affirmatively_adjudicated", "migrated_positive"),
        "night_regime_needs_night_source": (kind == "election-night")
        & (capability != "election_night"),
        "final_regime_needs_final_source": kind.isin("certified", "final")
        & (capability != "final"),
    }


def id_drift_rules() -> dict[str, Column]:
    """Stored regime and unit ids must equal the ids rebuilt from their parts."""
    regime = ids.reporting_regime_id(F.col("jurisdiction_id"), F.col("election_id"),
                                     F.col("regime_kind"), F.col("source_id"))
    unit = ids.reporting_unit_id(
        F.split("jurisdiction_id", ":")[1], F.col("election_id"), F.col("reporting_regime_id"),
        F.col("unit_type"), F.col("raw_name"), F.coalesce("source_native_id", F.lit("")))
    return {
        "regime_id_drift": ~F.col("reporting_regime_id").eqNullSafe(regime),
        "unit_id_drift": ~F.col("reporting_unit_id").eqNullSafe(unit),
        "unit_parents_itself": F.col("parent_reporting_unit_id") == F.col("reporting_unit_id"),
    }


def lead_intake(leads: DataFrame, localities: DataFrame, order: str) -> tuple[
        DataFrame, DataFrame]:
    """Accepted inspection seeds and quarantined leads with their first failing reason.

    Unsafe URLs are withheld from the quarantine; the last accepted row of a URL, unit and
    source wins.
    """
    known = localities.select("jurisdiction_id", F.col("state").alias("_state")).distinct()
    original = [c for c in leads.columns if c != order]
    row_hash = F.sha2(F.to_json(F.struct(*sorted(original)), {"ignoreNullFields": "false"}), 256)
    rows = leads.withColumn("row_sha256", row_hash).join(known, "jurisdiction_id", "left")
    rows = U.normalize_urls(U.normalize_urls(rows, "url", "_url"), "discovered_from", "_source")
    url_ok = (F.col("_url") != "") & U.publishable(F.col("_url"))
    source_ok = (F.col("_source") != "") & U.publishable(F.col("_source"))
    dated = F.col("observed_at").rlike(r"^\d{4}-\d\d-\d\d([T ].*)?(Z|[+-]\d\d:?\d\d)$")
    reason = first_violation({
        "unknown_jurisdiction": F.col("_state").isNull(),
        "state_mismatch": ~F.col("state").eqNullSafe(F.col("_state")),
        "invalid_evidence_status": ~F.col("evidence_status").eqNullSafe("observed_link_candidate"),
        "missing_evidence": _blank("evidence_excerpt"),
        "invalid_observation_time": ~F.coalesce(dated, F.lit(False)),
        "unsafe_or_unsupported_url": ~url_ok,
        "unsafe_or_unsupported_evidence_url": ~source_ok,
        "artifact_requires_inspection": U.path(F.col("_url")).rlike(U.ARTIFACT_PATTERN),
    })
    judged = bind(rows, reason=reason, _shown=F.when(url_ok, F.col("_url")).otherwise("[withheld]"),
                  _from=F.when(source_ok, F.col("_source")).otherwise("[withheld]"))
    rejected = judged.filter("reason is not null").select(
        F.col(order).alias("input_row"), F.when(F.col("_state").isNotNull(),
                                                F.col("jurisdiction_id")).alias("jurisdiction_id"),
        F.col("_state").alias("state"), "reason", F.col("_shown").alias("url"),
        F.col("_from").alias("evidence_url"), "row_sha256")
    good = judged.filter("reason is null").groupBy(
        F.col("_url").alias("url"), "jurisdiction_id", F.col("_source").alias("observed_from")
    ).agg(F.max_by(F.struct("state", "evidence_excerpt", "observed_at"), order).alias("r"))
    return good.select("url", "jurisdiction_id", "observed_from", "r.*"), rejected


def ledger_violations(ledger: DataFrame) -> DataFrame:
    """Ledger rows that cannot be loaded (V21): bad URL, missing fields, repeated identity."""
    rows = ledger.withColumn("_url", U.canonical_url(F.col("source_url")))
    own = violations(rows, ["jurisdiction_id", "source_url"], {
        "invalid_url": F.col("_url").isNull(),
        "missing_flag": F.col("ever_verified").isNull() | F.col("currently_reachable").isNull(),
        "missing_check_time": _blank("last_checked_at"),
    })
    twice = rows.filter("_url is not null").groupBy("jurisdiction_id", "_url").agg(
        F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
        "jurisdiction_id", F.col("_url").alias("source_url"),
        F.lit("duplicate_identity").alias("rule_id"))
    return own.unionByName(twice)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns a table lacks."""
    return sorted(set(required) - set(df.columns))


def binding_violations(capabilities: DataFrame, localities: DataFrame,
                       bridges: DataFrame | None = None) -> DataFrame:
    """Capabilities against their locality and its authority."""
    loc = localities.groupBy("jurisdiction_id").agg(
        F.max("authority_id").alias("_authority"), F.count(F.lit(1)).alias("_n"))
    joined = capabilities.join(loc, "jurisdiction_id", "left")
    rules = {
        "duplicate_locality": F.col("_n") > 1,
        "unknown_locality": F.col("_n").isNull(),
        "authority_disagrees": F.col("_n").isNotNull()
        & ~F.col("authority_id").eqNullSafe(F.col("_authority")),
    }
    if bridges is not None:
        pairs = bridges.filter(F.col("status") == "verified").select(
            "authority_id", "jurisdiction_id").distinct().withColumn("_bridged", F.lit(True))
        joined = joined.join(pairs, ["authority_id", "jurisdiction_id"], "left")
        rules["no_authority_bridge"] = F.col("_bridged").isNull()
    return violations(joined, ["jurisdiction_id", "authority_id"], rules)


def self_alias_violations(resolved: DataFrame, value: str) -> DataFrame:
    """Values that do not resolve to themselves by alias."""
    return resolved.filter(~F.col(value).eqNullSafe(F.col("canonical_id"))).select(
        value, "canonical_id", F.lit("identity_not_self").alias("rule_id"))
