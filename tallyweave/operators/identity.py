"""Temporal, namespaced aliases and bridges between identities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.ids import alias_token
from tallyweave.operators.intervals import (
    adjacent_overlaps, overlap_conflicts, overlaps_any, resolve_as_of)

LOOKUP = ["object_type", "_namespace", "_alias"]
DECISION = ["object_type", "canonical_id", "alias_kind", "alias_value", "alias_namespace",
            "status", "confidence", "reconciliation_method", "evidence_reference", "reviewer",
            "effective_from", "effective_to"]


def with_lookup_key(df: DataFrame) -> DataFrame:
    return df.withColumn("_namespace", F.lower(F.trim("alias_namespace"))).withColumn(
        "_alias", alias_token(F.col("alias_value")))


def resolve_aliases(probes: DataFrame, aliases: DataFrame) -> DataFrame:
    """Canonical id per probe ``(object_type, alias_namespace, alias_value, when)``.

    Only verified aliases count. Without a date every dated alias is ignored. More than one
    distinct id resolves to null.
    """
    keyed = with_lookup_key(probes)
    verified = with_lookup_key(aliases).filter("status = 'verified'")
    dated = resolve_as_of(keyed, verified, LOOKUP, "canonical_id", "effective_from",
                          "effective_to", "when")
    timeless = (
        verified.filter("effective_from is null and effective_to is null")
        .groupBy(*LOOKUP)
        .agg(F.min("canonical_id").alias("_lo"), F.max("canonical_id").alias("_hi"))
        .filter("_lo = _hi")
        .select(*LOOKUP, F.lit(None).cast("date").alias("when"),
                F.col("_lo").alias("canonical_id"))
    )
    answers = dated.unionByName(timeless).select(
        *[F.col(k).alias(f"_k{k}") for k in LOOKUP], F.col("when").alias("_kwhen"),
        "canonical_id")
    cond = reduce(lambda a, k: a & (F.col(k) == F.col(f"_k{k}")), LOOKUP,
                  F.col("when").eqNullSafe(F.col("_kwhen")))
    return keyed.join(answers, cond, "left").select(*probes.columns, "canonical_id")


def resolve_undated(probes: DataFrame, aliases: DataFrame) -> DataFrame:
    """Canonical id per probe by verified aliases without dates; several ids resolve to null.

    The form of ``resolve_aliases`` for probes that have no date: one aggregate and one join.
    """
    timeless = (
        with_lookup_key(aliases)
        .filter("status = 'verified' and effective_from is null and effective_to is null")
        .groupBy(*LOOKUP).agg(F.min("canonical_id").alias("_lo"), F.max("canonical_id").alias("_hi"))
        .filter("_lo = _hi").select(*LOOKUP, F.col("_lo").alias("canonical_id")))
    return with_lookup_key(probes).join(timeless, LOOKUP, "left").select(
        *probes.columns, "canonical_id")


def alias_collisions(aliases: DataFrame) -> DataFrame:
    """Verified aliases of one key that give two ids at the same time."""
    verified = with_lookup_key(aliases).filter("status = 'verified'")
    out = overlap_conflicts(verified, LOOKUP, "canonical_id", "effective_from", "effective_to")
    return out.withColumnsRenamed({"_namespace": "alias_namespace", "_alias": "alias"})


def external_alias(aliases: DataFrame, order: str, namespace: str | None = None) -> DataFrame:
    """The unique verified external alias of each canonical id; no pick among several."""
    rows = with_lookup_key(aliases).filter(
        "status = 'verified' and alias_kind = 'external_id'")
    if namespace is not None:
        rows = rows.filter(F.col("_namespace") == namespace.strip().lower())
    key = F.struct("_namespace", "_alias")
    return (
        rows.groupBy("canonical_id")
        .agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"),
             F.max_by("alias_value", order).alias("alias_value"))
        .filter("_lo = _hi")
        .select("canonical_id", F.col("_lo._namespace").alias("alias_namespace"), "alias_value")
    )


def merge_aliases(existing: DataFrame, additions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add decisions that are not already present, and report forbidden downgrades.

    A weaker decision over a time when the alias is already verified is a violation.
    """
    columns = [c for c in DECISION if c in existing.columns]
    old = existing.select(*columns).distinct()
    renamed = old.select(*[F.col(c).alias(f"_k_{c}") for c in columns])
    cond = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"_k_{c}")), columns, F.lit(True))
    fresh = additions.select(*columns).distinct().join(renamed, cond, "left_anti")
    downgrades = overlaps_any(
        with_lookup_key(fresh.filter("status <> 'verified'")),
        with_lookup_key(existing.filter("status = 'verified'")),
        LOOKUP, "effective_from", "effective_to", ["canonical_id", "status"])
    return old.unionByName(fresh), downgrades


def crosswalk_overlaps(bridges: DataFrame) -> DataFrame:
    """Overlapping validity periods of one authority and jurisdiction."""
    return adjacent_overlaps(bridges, ["authority_id", "jurisdiction_id"], "effective_from",
                             "effective_to", "evidence_url")


def relationship_conflicts(crosswalk: DataFrame, keys: list[str]) -> DataFrame:
    """One pair of units under two relationship types at the same time."""
    return overlap_conflicts(crosswalk, keys, "relationship_type", "effective_from",
                             "effective_to")


def exclusive_geography_violations(crosswalk: DataFrame) -> DataFrame:
    """Units that claim geography while non-geographic, or exactness to two places."""
    synthetic = F.col("relationship_type") == "synthetic_non_geographic"
    mixed = overlaps_any(
        crosswalk.filter(synthetic), crosswalk.filter(~synthetic), ["reporting_unit_id"],
        "effective_from", "effective_to", ["relationship_type"])
    exact = overlap_conflicts(
        crosswalk.filter("relationship_type = 'exact'"), ["reporting_unit_id"],
        "geographic_unit_id", "effective_from", "effective_to")
    return (
        mixed.select("reporting_unit_id", F.lit("non_geographic_with_geography").alias("rule_id"))
        .unionByName(exact.select("reporting_unit_id",
                                  F.lit("exact_to_several_geographies").alias("rule_id")))
        .distinct()
    )


def allocation_weight_findings(crosswalk: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Audit of geographic weights per unit and interval (A12); first failing rule per group."""
    kinds = ["split_across", "aggregate_of", "reassigned", "approximate"]
    w = F.col("allocation_weight")
    weighted = w.isNotNull()
    groups = (
        crosswalk.filter(F.col("relationship_type").isin(kinds))
        .groupBy("reporting_unit_id", "effective_from", "effective_to")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(w).alias("weighted"),
            F.sum(w).alias("total"),
            F.count_distinct(F.when(weighted, F.coalesce("weight_basis", F.lit(""))))
            .alias("bases"),
            F.count_distinct(F.when(weighted, F.col("allocation_coverage"))).alias("coverages"),
            F.max(F.when(weighted, F.col("allocation_coverage"))).alias("coverage"),
            F.count_distinct(F.when(weighted, F.col("unmapped_weight"))).alias("unmapped_values"),
            F.count_distinct(F.when(weighted & F.col("unmapped_weight").isNotNull(),
                                    F.coalesce("unmapped_basis", F.lit(""))))
            .alias("unmapped_bases"),
            F.max(F.when(weighted, F.col("unmapped_weight"))).alias("unmapped"),
        )
        .filter("weighted > 0")
    )
    total, unmapped = F.col("total"), F.col("unmapped")
    finding = (
        F.when(F.col("weighted") != F.col("rows"), "mixed_weighted_and_unweighted")
        .when(F.col("bases") != 1, "inconsistent_weight_basis")
        .when(F.col("coverages") != 1, "inconsistent_coverage")
        .when(total > 1 + tolerance, "weights_exceed_one")
        .when((F.col("unmapped_values") > 1) | (F.col("unmapped_bases") > 1),
              "inconsistent_unmapped_share")
        .when((F.col("coverage") == "complete") & (F.abs(total - 1) > tolerance),
              "complete_weights_not_one")
        .when((F.col("coverage") == "partial") & (total >= 1 - tolerance),
              "partial_without_residual")
        .when((F.col("coverage") == "partial") & unmapped.isNotNull()
              & (F.abs(total + unmapped - 1) > tolerance), "mapped_plus_unmapped_not_one")
    )
    return groups.withColumn("finding", finding).filter("finding is not null").select(
        "reporting_unit_id", "effective_from", "effective_to", "total", "coverage", "finding")
