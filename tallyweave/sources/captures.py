"""Raw landing of captures, offline replay and execution evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions import classify as C
from tallyweave.operators import identity as I
from tallyweave.operators import observations as O
from tallyweave.operators import quality as Q
from tallyweave.operators.history import progress_findings
from tallyweave.sources import results as R
from tallyweave.sources.commit import add_rows, committed


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder as captures with their content hash."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "modificationTime", "length", "content",
                        F.sha2("content", 256).alias("sha256"))


def new_captures(captures: DataFrame, landed: DataFrame) -> DataFrame:
    """Captures whose bytes have not landed yet, one per hash."""
    fresh = captures.join(landed.select("sha256").distinct(), "sha256", "left_anti")
    return fresh.groupBy("sha256").agg(F.min_by(
        F.struct(*[c for c in captures.columns if c != "sha256"]), "path").alias("c")).select(
        "sha256", "c.*")


def land(captures: DataFrame, path: str) -> None:
    """Append captures under their hash prefix; equal bytes land once."""
    rows = captures.withColumn("prefix", F.left("sha256", F.lit(2)))
    rows.write.mode("append").partitionBy("prefix").parquet(path)


def land_once(captures: DataFrame, folder: str) -> None:
    """Add the captures whose bytes a folder does not hold yet (S16); running it again adds nothing."""
    landed = committed(captures.sparkSession, folder)
    fresh = new_captures(captures, captures.limit(0) if landed is None else landed)
    add_rows(fresh, folder)


def tampered(landed: DataFrame) -> DataFrame:
    """Landed captures whose bytes no longer give their hash."""
    return landed.filter(F.sha2("content", 256) != F.col("sha256")).select(
        "sha256", F.lit("content_mismatch").alias("rule_id"))


def capture_findings(facts: DataFrame, captures: DataFrame, body: str,
                     required_text: Column) -> DataFrame:
    """Why a capture cannot be accepted (P3, V5): marker, no rows, duplicates, negatives."""
    marker = Q.violations(captures, ["source_id"], Q.capture_rules(body, required_text))
    empty = captures.select("source_id").distinct().join(
        facts.select("source_id").distinct(), "source_id", "left_anti").select(
        "source_id", F.lit("no_rows").alias("rule_id"))
    twice = O.duplicate_keys(facts, ["source_id", "snapshot_sha256", *O.CAPTURE_KEY]).select(
        "source_id", F.lit("duplicate_observation").alias("rule_id"))
    negative = Q.violations(facts, ["source_id"], Q.observation_rules())
    return (marker.unionByName(empty).unionByName(twice).unionByName(negative)
            .groupBy("source_id", "rule_id").agg(F.count(F.lit(1)).alias("findings")))


def replay(facts: DataFrame, captures: DataFrame, progress: DataFrame | None = None,
           columns: list[str] | None = None, aliases: DataFrame | None = None,
           namespace: str = "replay") -> dict[str, DataFrame]:
    """Checks and digests of one replay (P1): every result is a table, built lazily.

    ``captures`` carries source_id, body and expected_sha256. With ``aliases`` its jurisdiction_id must
    resolve to itself in the namespace (V24). Where it carries regime_kind and capability_type these must
    agree (V15). Facts of captures that break one of these are left out of the digest.
    """
    same = F.sha2("body", 256) == F.col("expected_sha256")
    out = {"altered": captures.filter(~F.coalesce(same, F.lit(False))).select(
        "source_id", F.lit("snapshot_digest_mismatch").alias("rule_id"))}
    if aliases is not None:
        probes = captures.select(
            "source_id", "jurisdiction_id", F.lit("jurisdiction").alias("object_type"),
            F.lit(namespace).alias("alias_namespace"), F.col("jurisdiction_id").alias("alias_value"))
        resolved = I.resolve_undated(probes, aliases)
        own = F.col("canonical_id")
        out["identity"] = Q.violations(resolved, ["source_id"], {
            "identity_unresolved": own.isNull(),
            "identity_not_self": ~own.eqNullSafe(F.col("jurisdiction_id")) & own.isNotNull()})
    if {"regime_kind", "capability_type"} <= set(captures.columns):
        rules = {k: v for k, v in Q.regime_rules().items() if k != "capability_not_positive"}
        out["regime"] = Q.violations(captures, ["source_id"], rules)
    refused = out["altered"].select("source_id")
    for name in ("identity", "regime"):
        if name in out:
            refused = refused.unionByName(out[name].select("source_id"))
    kept = facts.join(refused.distinct(), "source_id", "left_anti")
    out |= {
        "provenance": Q.violations(kept, ["source_id", "reporting_unit_id"], Q.topology_rules()),
        "double_counts": O.double_count_violations(kept),
        "digest": O.table_digest(kept, columns or DIGEST_COLUMNS, scope=["source_id"]),
    }
    if progress is not None:
        out["progress"] = progress_findings(progress)
    return out


DIGEST_COLUMNS = ["election_id", "jurisdiction_id", "reporting_unit_id", "contest_name",
                  "choice_name", "party", "vote_mode", "raw_vote_mode", "votes", "source_order",
                  "snapshot_sha256"]


def with_route(captures: DataFrame) -> DataFrame:
    """Add ``_kind``, what the bytes are, and ``_route``: the given route, or if that cannot be executed
    the one of the kind."""
    rows = captures.withColumn("_kind", R.payload_kind(F.col("content")))
    sniffed = C.payload_route(F.col("_kind"))["route"]
    executable = F.col("route").isin(C.EXECUTABLE)
    return rows.withColumn("_route", F.when(
        executable | (sniffed == ""), F.col("route")).otherwise(sniffed))


def execution_evidence(captures: DataFrame, facts: DataFrame) -> DataFrame:
    """Stage, failure and counts of every routed capture.

    ``captures`` has state, result_url, access_family, route, content and smallest_observed_unit;
    ``facts`` has result_url, raw_vote_mode for the captures that a parser read. A payload that
    is JSON or CSV by its bytes is re-routed when its route cannot be executed.
    """
    counts = facts.groupBy("result_url").agg(
        F.count(F.lit(1)).alias("observation_count"),
        F.bool_or(~F.coalesce("raw_vote_mode", F.lit("")).isin("", "total", "votes"))
        .alias("vote_modes_preserved"))
    rows = with_route(captures).join(counts, "result_url", "left")
    can = F.col("_route").isin(C.EXECUTABLE)
    n = F.coalesce("observation_count", F.lit(0))
    bad_json = (F.col("_route") == "nested_json") & (F.col("_kind") != "json")
    failure = (
        F.when(F.col("_route").isin(C.DISCOVERY), "requires_download_artifact_selection")
        .when(~can, "parser_not_executable").when(bad_json, "invalid_json_payload")
        .when(n == 0, "no_normalized_observations").otherwise("")
    )
    stage = (
        F.when(F.col("_route").isin(C.DISCOVERY), 2).when(~can | bad_json, 3)
        .when(n == 0, 4).otherwise(6)
    )
    return rows.select(
        "state", "result_url", "access_family", F.col("_route").alias("parser"),
        stage.alias("stage"), n.alias("observation_count"), "smallest_observed_unit",
        F.when(n > 0, F.col("vote_modes_preserved")).alias("vote_modes_preserved"),
        failure.alias("failure_class"), F.sha2("content", 256).alias("snapshot_sha256"))


def maturity_rows(evidence: DataFrame) -> DataFrame:
    """Evidence as text columns for publication."""
    ladder = F.array(*[F.lit(s) for s in C.STAGES])
    return evidence.select(
        "state", "result_url", "access_family", "parser",
        F.element_at(ladder, F.col("stage")).alias("execution_stage"),
        F.col("observation_count").cast("string"), "smallest_observed_unit",
        F.coalesce(F.col("vote_modes_preserved").cast("string"), F.lit(""))
        .alias("vote_modes_preserved"), "failure_class", "snapshot_sha256")
