"""Queries over data-quality rules, identifiers, value parsers and decision tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions import classify as C
from tallyweave.functions import ids, urls as U, values as N
from tallyweave.operators import catalog as K, quality as Q
from tallyweave.plans.registry import query
from tallyweave.plans.views import captured_pages, observations, table
from tallyweave.sources import captures as S, dispatch as D, results as R
from tallyweave.sources import registry as G


@query("progress_violations", """
WITH p AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events)
SELECT event_id, 'counts_missing' AS rule_id FROM p WHERE event_type = 'view' AND k % 10 = 0
UNION ALL SELECT event_id, 'negative_reporting_count' FROM p WHERE event_type = 'view' AND k % 10 = 1
UNION ALL SELECT event_id, 'counts_on_other_kind' FROM p WHERE event_type = 'click' AND k % 10 > 0
UNION ALL SELECT event_id, 'negative_reporting_count' FROM p WHERE event_type = 'click' AND k % 10 = 1
UNION ALL SELECT event_id, 'unit_scope_needs_unit' FROM p WHERE k % 7 = 0
UNION ALL SELECT event_id, 'complete_missing' FROM p WHERE event_type = 'click' AND k % 3 = 0
UNION ALL SELECT event_id, 'completion_without_status' FROM p WHERE event_type = 'click'
UNION ALL SELECT event_id, 'complete_on_other_kind' FROM p WHERE event_type <> 'click' AND k % 3 > 0
UNION ALL SELECT event_id, 'components_missing' FROM p WHERE event_type = 'error' AND k % 2 = 0
UNION ALL SELECT event_id, 'components_repeat' FROM p WHERE event_type = 'error' AND k % 2 = 1
UNION ALL SELECT event_id, 'components_on_other_kind' FROM p WHERE event_type <> 'error' AND k % 2 = 1
UNION ALL SELECT event_id, 'counts_on_other_kind' FROM p WHERE event_type NOT IN ('view', 'click') AND k % 10 > 0
UNION ALL SELECT event_id, 'negative_reporting_count' FROM p WHERE event_type NOT IN ('view', 'click') AND k % 10 = 1
UNION ALL SELECT event_id, 'reported_missing' FROM p WHERE event_type IN ('signup', 'purchase')
""")
def progress_violations(spark, sf_dir):
    e = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("long")
    none = F.lit(None)
    rows = table(spark, sf_dir, "events").withColumn("k", k).select(
        "event_id", F.when(F.col("k") % 7 == 0, "reporting_unit").otherwise("source")
        .alias("scope"),
        F.when(e == "view", "source_counts").when(e == "click", "source_complete")
        .when(e == "error", "expected_components").otherwise("unit_exists").alias("kind"),
        none.cast("string").alias("reporting_unit_id"), none.cast("string").alias("contest_id"),
        F.when(F.col("k") % 10 == 1, -1).when(F.col("k") % 10 > 1, 5).alias("reporting_count"),
        none.cast("long").alias("expected_count"),
        F.when(F.col("k") % 3 > 0, True).alias("complete"), none.cast("boolean").alias("reported"),
        F.when(F.col("k") % 2 == 1, F.array(F.lit("a"), F.lit("a"))).alias("expected_components"),
        none.cast("array<string>").alias("observed_components"),
        none.cast("string").alias("snapshot_sha256"), F.lit("source_reported").alias("basis"),
        none.cast("string").alias("raw_status"))
    return Q.violations(rows, ["event_id"], Q.progress_rules())


@query("topology_violations", """
SELECT o_orderkey, 'topology_without_snapshot' AS rule_id FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 'topology_without_canonical_jurisdiction' FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, 'topology_without_regime' FROM orders WHERE o_orderstatus = 'F'
""")
def topology_violations(spark, sf_dir):
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(s == "O", "r").alias("reporting_regime_id"),
        F.when(s == "F", "name").alias("reporting_unit_raw_name"),
        F.lit(None).cast("string").alias("reporting_unit_source_native_id"),
        F.when(k % 3 > 0, F.sha2(k.cast("string"), 256)).otherwise("abc")
        .alias("snapshot_sha256"),
        F.when(k % 5 == 0, "mi-x").otherwise("us:mi:x").alias("jurisdiction_id"))
    return Q.violations(rows, ["o_orderkey"], Q.topology_rules())


@query("geo_crosswalk_violations", """
WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, l_quantity AS q, l_returnflag AS f, l_linestatus AS s FROM lineitem),
t AS (SELECT *, CASE f WHEN 'A' THEN 'exact' WHEN 'N' THEN 'synthetic_non_geographic' ELSE 'split_across' END AS t, q > 10 AS w, (q - 5) / 40 AS wt FROM l),
v AS (SELECT unnest(list_filter([CASE WHEN f = 'N' AND s = 'F' THEN 'non_geographic_with_geography' END, CASE WHEN f <> 'N' AND s = 'O' THEN 'geography_missing' END,
  CASE WHEN w AND (wt < 0 OR wt > 1) THEN 'weight_out_of_range' END, CASE WHEN w AND n > 4 THEN 'weight_without_basis' END,
  CASE WHEN w AND f <> 'R' THEN 'weight_on_exact' END], lambda x: x IS NOT NULL)) AS rule_id FROM t)
SELECT rule_id, count(*) AS findings FROM v GROUP BY ALL
""")
def geo_crosswalk_violations(spark, sf_dir):
    f, q = F.col("l_returnflag"), F.col("l_quantity")
    kind = (F.when(f == "A", "exact").when(f == "N", "synthetic_non_geographic")
            .otherwise("split_across"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), kind.alias("relationship_type"),
        F.when(F.col("l_linestatus") == "F", "g").alias("geographic_unit_id"),
        F.sha2(F.col("l_orderkey").cast("string"), 256).alias("evidence_snapshot_sha256"),
        F.when(q > 10, (q - 5) / 40).alias("allocation_weight"),
        F.when(F.col("l_linenumber") <= 4, "basis").alias("weight_basis"),
        F.lit("unknown").alias("allocation_coverage"),
        F.lit(None).cast("double").alias("unmapped_weight"),
        F.lit(None).cast("string").alias("unmapped_basis"),
        F.lit(None).cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"))
    return Q.violations(rows, ["k"], Q.geo_crosswalk_rules()).groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("findings"))


@query("capability_violations", """
SELECT o_orderkey, 'inverted_interval' AS rule_id FROM orders WHERE o_orderkey % 9 = 0
UNION ALL SELECT o_orderkey, 'no_evidence' FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT o_orderkey, 'bad_digest' FROM orders WHERE o_orderpriority = '2-HIGH'
UNION ALL SELECT o_orderkey, 'method_missing' FROM orders WHERE o_orderstatus = 'P'
""")
def capability_violations(spark, sf_dir):
    k, p = F.col("o_orderkey"), F.col("o_orderpriority")
    day = F.to_date("o_orderdate")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lit("us:mi:x").alias("jurisdiction_id"),
        F.lit("us:authority:mi:x").alias("authority_id"), F.lit("s").alias("source_id"),
        F.when(F.col("o_orderstatus") == "P", " ").otherwise("m").alias("assessment_method"),
        F.when(p == "5-LOW", "").when(p == "2-HIGH", "zz").otherwise(
            F.upper(F.sha2(k.cast("string"), 256))).alias("evidence_snapshot_sha256"),
        F.lit("").alias("evidence_reference"), day.alias("valid_from"),
        F.when(k % 9 == 0, F.date_sub(day, 1)).otherwise(day).alias("valid_to"))
    return Q.violations(rows, ["o_orderkey"], Q.capability_rules())


@query("locality_violations", """
WITH c AS (SELECT c_custkey, c_mktsegment AS s, c_acctbal > 0 AS f, c_custkey % 2 = 0 AS n FROM customer),
t AS (SELECT *, CASE s WHEN 'BUILDING' THEN 'known_missing_source' WHEN 'AUTOMOBILE' THEN 'both' WHEN 'MACHINERY' THEN 'final_only' WHEN 'HOUSEHOLD' THEN 'election_night_only' ELSE 'enumerated_unresolved' END AS st FROM c)
SELECT c_custkey, 'status_disagrees_with_flags' AS rule_id FROM t WHERE (st = 'both' AND NOT (f AND n)) OR (st = 'final_only' AND NOT (f AND NOT n))
  OR (st = 'election_night_only' AND NOT (n AND NOT f)) OR (st = 'enumerated_unresolved' AND (f OR n))
UNION ALL SELECT c_custkey, 'missing_source_is_capable' FROM t WHERE st = 'known_missing_source' AND (f OR n)
UNION ALL SELECT c_custkey, 'missing_source_not_adjudicated' FROM t WHERE st = 'known_missing_source' AND c_custkey % 3 > 0
""")
def locality_violations(spark, sf_dir):
    s = F.col("c_mktsegment")
    status = (F.when(s == "BUILDING", "known_missing_source").when(s == "AUTOMOBILE", "both")
              .when(s == "MACHINERY", "final_only").when(s == "HOUSEHOLD", "election_night_only")
              .otherwise("enumerated_unresolved"))
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.lit("us:mi:x").alias("jurisdiction_id"), F.lit("").alias("authority_id"),
        status.alias("coverage_status"), (F.col("c_acctbal") > 0).alias("final_capable"),
        (F.col("c_custkey") % 2 == 0).alias("election_night_capable"),
        F.when(F.col("c_custkey") % 3 == 0, "affirmatively_adjudicated").alias("assessment_status"),
        F.lit("m").alias("assessment_method"))
    return Q.violations(rows, ["c_custkey"], Q.locality_rules())


@query("evidence_violations", """
WITH l AS (SELECT l_orderkey AS k, CAST(l_quantity AS INT) % 7 + 1 AS st, l_linenumber - 1 AS n, l_returnflag = 'A' AS bad, l_linestatus = 'F' AS sha FROM lineitem)
SELECT 'normalized_without_rows' AS rule_id, count(*) AS findings FROM l WHERE st >= 5 AND n <= 0
UNION ALL SELECT 'replay_without_snapshot', count(*) FROM l WHERE st >= 6 AND NOT sha
UNION ALL SELECT 'normalized_with_failure', count(*) FROM l WHERE st >= 5 AND bad
UNION ALL SELECT 'promotable', count(*) FROM l WHERE st >= 5 AND n > 0 AND NOT bad AND (st = 5 OR sha)
""")
def evidence_violations(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), (F.col("l_quantity").cast("int") % 7 + 1).alias("stage"),
        (F.col("l_linenumber") - 1).alias("observation_count"),
        F.when(F.col("l_returnflag") == "A", "http_404").alias("failure_class"),
        F.when(F.col("l_linestatus") == "F", "x").alias("snapshot_sha256"))
    bad = Q.violations(rows, ["k"], Q.evidence_rules()).groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("findings"))
    return bad.unionByName(Q.promotable(rows).agg(F.count(F.lit(1)).alias("findings")).select(
        F.lit("promotable").alias("rule_id"), "findings"))


@query("edge_violations", """
SELECT l_orderkey AS k, 'self_edge' AS rule_id FROM lineitem WHERE l_suppkey = l_partkey
UNION ALL SELECT l_orderkey, 'containment_marked_additive' FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'
""")
def edge_violations(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("parent_id"),
        F.col("l_partkey").alias("child_id"),
        F.when(F.col("l_returnflag") == "A", "contains").otherwise("reports_to")
        .alias("relation"), F.when(F.col("l_linestatus") == "F", True).alias("additive"))
    return Q.violations(rows, ["k"], Q.edge_rules())


def _leads(spark, sf_dir):
    k, p = F.col("o_orderkey"), F.col("o_orderpriority")
    lo = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("jurisdiction_id"),
        F.col("c_nationkey").cast("string").alias("state"))
    leads = table(spark, sf_dir, "orders").select(
        k.alias("seq"), (F.col("o_custkey") + F.when(k % 11 == 0, 10_000_000).otherwise(0))
        .cast("string").alias("jurisdiction_id"), (F.col("o_custkey") % 25).cast("string")
        .alias("state"),
        F.when(p == "1-URGENT", "other").otherwise("observed_link_candidate")
        .alias("evidence_status"), F.when(p == "2-HIGH", " ").otherwise("text")
        .alias("evidence_excerpt"),
        F.when(p == "3-MEDIUM", "2026-01-01T00:00:00").otherwise("2026-01-01T00:00:00Z")
        .alias("observed_at"),
        F.concat(F.lit("https://x.example.org/"), F.col("o_custkey") % 40,
                 F.when(k % 2 == 0, ".pdf").otherwise("")).alias("url"),
        F.lit("https://d.example.org/").alias("discovered_from"))
    return leads, lo


@query("lead_intake", """
WITH l AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'unknown_jurisdiction' WHEN c_nationkey <> o_custkey % 25 THEN 'state_mismatch'
  WHEN o_orderpriority = '1-URGENT' THEN 'invalid_evidence_status' WHEN o_orderpriority = '2-HIGH' THEN 'missing_evidence'
  WHEN o_orderpriority = '3-MEDIUM' THEN 'invalid_observation_time' WHEN o_orderkey % 2 = 0 THEN 'artifact_requires_inspection' END AS reason, o_custkey
  FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT reason, count(*) AS leads FROM l WHERE reason IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'accepted', count(*) FROM (SELECT DISTINCT o_custkey FROM l WHERE reason IS NULL)
""")
def lead_intake(spark, sf_dir):
    leads, lo = _leads(spark, sf_dir)
    good, bad = Q.lead_intake(leads, lo, "seq")
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("leads")).unionByName(
        good.agg(F.count(F.lit(1)).alias("leads")).select(F.lit("accepted").alias("reason"),
                                                          "leads"))


@query("ledger_violations", r"""
WITH u AS (SELECT page_id, lower(regexp_replace(url, '#.*$', '')) AS c, url FROM pages)
SELECT count(*) AS findings, 'missing_flag' AS rule_id FROM pages WHERE page_id % 6 = 0
UNION ALL SELECT count(*), 'invalid_url' FROM pages WHERE page_id % 10 = 0
UNION ALL SELECT count(*), 'duplicate_identity' FROM (SELECT regexp_extract(url, '^https?://[^/]+', 0) AS h FROM pages WHERE page_id % 10 > 0 GROUP BY ALL HAVING count(*) > 1)
""")
def ledger_violations(spark, sf_dir):
    root = F.regexp_extract("url", "^https?://[^/]+", 0)
    rows = table(spark, sf_dir, "pages").select(
        F.lit("j").alias("jurisdiction_id"),
        F.when(F.col("page_id") % 10 == 0, "ftp://x").otherwise(F.upper(root))
        .alias("source_url"), F.when(F.col("page_id") % 6 > 0, True).alias("ever_verified"),
        F.lit(True).alias("currently_reachable"), F.lit("t").alias("last_checked_at"))
    return Q.ledger_violations(rows).groupBy("rule_id").agg(F.count(F.lit(1)).alias("findings"))


@query("binding_violations", """
WITH o AS (SELECT o_orderkey, o_custkey + CASE WHEN o_orderkey % 6 = 0 THEN 1000000000 ELSE 0 END AS o_custkey FROM orders),
b AS (SELECT o_orderkey, o_custkey, c_custkey, c_nationkey, o_orderkey % 25 AS a FROM o LEFT JOIN customer ON c_custkey = o_custkey)
SELECT o_custkey, 'unknown_locality' AS rule_id, count(*) AS n FROM b WHERE c_custkey IS NULL GROUP BY ALL
UNION ALL SELECT o_custkey, 'authority_disagrees', count(*) FROM b WHERE c_custkey IS NOT NULL AND c_nationkey <> a GROUP BY ALL
UNION ALL SELECT o_custkey, 'no_authority_bridge', count(*) FROM b WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = o_custkey AND s_nationkey = a) GROUP BY ALL
""")
def binding_violations(spark, sf_dir):
    caps = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + F.when(F.col("o_orderkey") % 6 == 0, 1_000_000_000).otherwise(0))
        .alias("jurisdiction_id"), (F.col("o_orderkey") % 25).cast("int").alias("authority_id"))
    lo = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("jurisdiction_id"), F.col("c_nationkey").alias("authority_id"))
    bridges = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("jurisdiction_id"), F.col("s_nationkey").alias("authority_id"),
        F.lit("verified").alias("status"))
    return Q.binding_violations(caps, lo, bridges).groupBy(
        F.col("jurisdiction_id").alias("o_custkey"), "rule_id").agg(F.count(F.lit(1)).alias("n"))


@query("payload_violations", """
SELECT o_orderkey, 'incomplete_row' AS rule_id FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, 'missing_votes' FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT o_orderkey, 'votes_not_integer' FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def payload_violations(spark, sf_dir):
    p = F.col("o_orderpriority")
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", "p").alias("Precinct"),
        F.lit("r").alias("Race"), F.lit("c").alias("Option"),
        F.when(p == "5-LOW", "").when(p == "1-URGENT", "1.5").otherwise("1,000").alias("Total"))
    return Q.wide_payload_violations(raw, ["o_orderkey"])


@query("json_payload_violations", """
WITH o AS (SELECT o_orderkey, o_orderkey % 9 AS k FROM orders)
SELECT o_orderkey, 'unsupported_schema' AS rule_id FROM o WHERE k IN (0, 1)
UNION ALL SELECT o_orderkey, 'invalid_unit' FROM o WHERE k = 2
UNION ALL SELECT o_orderkey, 'invalid_contest' FROM o WHERE k = 3
UNION ALL SELECT o_orderkey, 'votes_not_integer' FROM o WHERE k BETWEEN 4 AND 6
""")
def json_payload_violations(spark, sf_dir):
    """One document per order; its key decides which part of it is malformed."""
    k = F.col("o_orderkey") % 9
    votes = (F.when(k == 4, ',"votes":1.5').when(k == 5, ',"votes":true').when(k == 6, "")
             .when(k == 7, ',"votes":" 12 "').otherwise(F.concat(F.lit(',"votes":'), "o_orderkey")))
    contest = F.when(k == 3, '{"name":"g"}').otherwise(F.concat(
        F.lit('{"name":"g","choices":[{"name":"a"'), votes, F.lit("}]}")))
    unit = F.when(k == 2, '{"id":"u"}').otherwise(
        F.concat(F.lit('{"id":"u","contests":['), contest, F.lit("]}")))
    body = (F.when(k == 0, '{"reporting_units":{}}').when(k == 1, "[oops")
            .otherwise(F.concat(F.lit('{"reporting_units":['), unit, F.lit("]}"))))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", body.alias("body"))
    return Q.json_payload_violations(rows, "body", ["o_orderkey"])


@query("manifest_violations", """
SELECT CAST(c_custkey % 1000 AS VARCHAR) AS source_id, 'staleness_below_interval' AS rule_id FROM customer WHERE c_nationkey = 1
UNION ALL SELECT CAST(c_custkey % 1000 AS VARCHAR), 'enabled_without_review' FROM customer WHERE c_acctbal > 0 AND c_nationkey % 2 = 0
UNION ALL SELECT CAST(c_custkey % 1000 AS VARCHAR), 'unknown_parser' FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT CAST(c_custkey % 1000 AS VARCHAR), 'duplicate_source' FROM customer GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT NULL, 'several_elections'
""")
def manifest_violations(spark, sf_dir):
    feeds = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 1000).cast("string").alias("source_id"),
        F.lit(60).alias("interval_seconds"),
        F.when(F.col("c_nationkey") == 1, 30).otherwise(300).alias("stale_after_seconds"),
        (F.col("c_acctbal") > 0).alias("enabled"),
        F.when(F.col("c_nationkey") % 2 == 1, "https://e").alias("evidence_url"),
        F.lit("2026-01-01").alias("reviewed_at"),
        F.when(F.col("c_mktsegment") == "BUILDING", "x").otherwise("wide_csv").alias("parser"),
        F.col("c_mktsegment").alias("election_id"))
    return Q.manifest_violations(feeds)


@query("identifiers", """
WITH o AS (SELECT o_orderkey AS k, chr(CAST(65 + o_custkey % 26 AS INT)) || 'A' AS st, lower(chr(CAST(65 + o_custkey % 26 AS INT))) || 'a' AS s2, o_orderpriority AS p FROM orders)
SELECT k, 'us:' || s2 || ':county:order-' || CAST(k AS VARCHAR) AS jurisdiction_id, 'us:' || s2 || ':county:order-' || CAST(k AS VARCHAR) || ':authority:clerk:2' AS authority_id,
  'us:authority:' || s2 || ':board:' || trim(regexp_replace(lower(p), '[^a-z0-9]+', '-', 'g'), '-') AS election_authority_id,
  'us:' || s2 || ':county:order-' || CAST(k AS VARCHAR) || ':election:2026-general:regime:certified:src-1' AS regime_id,
  'us:' || s2 || ':county:order-' || CAST(k AS VARCHAR) || ':election:2026-general:regime:certified:src-1:reporting-unit:precinct:ward-' || CAST(k AS VARCHAR) AS unit_id,
  st AS state FROM o
""")
def identifiers(spark, sf_dir):
    k = F.col("o_orderkey")
    st = F.concat(F.char(65 + F.col("o_custkey") % 26), F.lit("A"))
    jid = ids.jurisdiction_id(st, F.lit("county"), F.concat(F.lit("Örder "), k))
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), st.alias("st"),
                                                 jid.alias("jurisdiction_id"), "o_orderpriority")
    regime = ids.reporting_regime_id(F.col("jurisdiction_id"), F.lit("2026 General"),
                                     F.lit("certified"), F.lit("src 1"))
    rows = rows.withColumn("regime_id", regime)
    return rows.select(
        "k", "jurisdiction_id",
        ids.scoped_authority_id(F.col("jurisdiction_id"), F.lit("Clerk"), F.lit(2))
        .alias("authority_id"),
        ids.election_authority_id(F.col("st"), F.lit("Board"), F.lit("x"),
                                  F.col("o_orderpriority")).alias("election_authority_id"),
        "regime_id", ids.reporting_unit_id(
            F.col("st"), F.lit("2026 general"), F.col("regime_id"), F.lit("precinct"),
            F.concat(F.lit("Ward #"), F.col("k"))).alias("unit_id"),
        ids.state_of_jurisdiction(F.col("jurisdiction_id")).alias("state"))


@query("id_drift", """
SELECT o_orderkey AS k, 'unit_id_drift' AS rule_id FROM orders WHERE o_orderpriority = '5-LOW' OR o_orderkey % 7 = 0
UNION ALL SELECT o_orderkey, 'regime_id_drift' FROM orders WHERE o_orderkey % 7 = 0
""")
def id_drift(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        k.alias("k"), F.lit("us:mi:county:x").alias("jurisdiction_id"),
        F.lit("e1").alias("election_id"), F.lit("final").alias("regime_kind"),
        F.lit("s1").alias("source_id"), F.lit("precinct").alias("unit_type"),
        F.concat(F.lit("Ward "), k).alias("raw_name"), F.lit("").alias("source_native_id"),
        F.lit(None).cast("string").alias("parent_reporting_unit_id"),
        F.concat(F.lit("us:mi:county:x:election:e1:regime:final:s1"),
                 F.when(k % 7 == 0, "x").otherwise("")).alias("reporting_regime_id"),
        F.concat(F.lit("us:mi:county:x:election:e1:regime:final:s1:reporting-unit:precinct:ward-"),
                 k, F.when(F.col("o_orderpriority") == "5-LOW", "b").otherwise(""))
        .alias("reporting_unit_id"))
    return Q.violations(rows, ["k"], Q.id_drift_rules())


@query("regime_violations", """
SELECT o_orderkey AS k, 'capability_not_positive' AS rule_id FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, 'night_regime_needs_night_source' FROM orders WHERE o_orderpriority < '3' AND o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, 'final_regime_needs_final_source' FROM orders WHERE o_orderpriority > '4' AND o_orderkey % 2 = 1
""")
def regime_violations(spark, sf_dir):
    p = F.col("o_orderpriority")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.when(p < "3", "election-night").when(p > "4", "certified").otherwise("other")
        .alias("regime_kind"),
        F.when(F.col("o_orderkey") % 2 == 0, "final").otherwise("election_night")
        .alias("capability_type"),
        F.when(F.col("o_orderstatus") == "P", "candidate").otherwise("verified")
        .alias("verification_status"))
    return Q.violations(rows, ["k"], Q.regime_rules())


@query("integer_parsers", """
WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, CAST(l_quantity AS BIGINT) AS q, l_returnflag AS f FROM lineitem)
SELECT k, n, p, CASE f WHEN 'A' THEN q * 1000 WHEN 'N' THEN NULL ELSE -q END AS lenient, CASE f WHEN 'A' THEN q * 1000 END AS strict,
  CASE f WHEN 'A' THEN q * 1000 WHEN 'N' THEN q ELSE -q END AS digits, CASE f WHEN 'A' THEN q * 1000 WHEN 'N' THEN q ELSE -q END AS first FROM l
""")
def integer_parsers(spark, sf_dir):
    q, f = F.col("l_quantity").cast("long"), F.col("l_returnflag")
    text = (F.when(f == "A", F.format_number(q * 1000, 0))
            .when(f == "N", F.concat(F.lit("about "), q, F.lit("%")))
            .otherwise(F.concat(F.lit(" -"), q)))
    t = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"),
        F.col("l_partkey").alias("p"), text.alias("t"))
    c = F.col("t")
    return t.select("k", "n", "p", N.lenient_int(c).alias("lenient"),
                    N.strict_count(c).alias("strict"), N.digits_or_zero(c).alias("digits"),
                    N.first_int(c).alias("first"))


@query("time_parsers", """
SELECT event_id, CASE WHEN event_type = 'view' THEN 0.0 ELSE floor(epoch_us(ts) / 1000000.0) - CASE WHEN event_type = 'click' THEN 7200 ELSE 0 END END::DOUBLE AS seconds,
  CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) + 18000 AS attached, CAST(ts AS DATE) BETWEEN DATE '2024-01-07' AND DATE '2024-01-20' AS in_window FROM events
""")
def time_parsers(spark, sf_dir):
    e = F.col("event_type")
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.concat(base, F.when(e == "view", "").when(e == "click", "+0200").otherwise("Z"))
    local = F.date_trunc("second", "ts")
    return table(spark, sf_dir, "events").select(
        "event_id", N.instant_seconds(text).alias("seconds"),
        F.unix_seconds(N.attach_zone(local, "-05:00")).alias("attached"),
        N.in_archive_window(F.to_date("ts"), F.lit("2024-01-10").cast("date"))
        .alias("in_window"))


@query("platform_families", """
WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS p, o_orderstatus AS s FROM orders)
SELECT k, CASE p WHEN '1-URGENT' THEN 'clarity' WHEN '2-HIGH' THEN 'electionware' WHEN '3-MEDIUM' THEN 'report_center_precinct_summary' WHEN '5-LOW' THEN 'statement_of_votes_cast' END AS page_platform,
  CASE p WHEN '1-URGENT' THEN 'clarity' WHEN '2-HIGH' THEN 'tabular_download' WHEN '3-MEDIUM' THEN 'pdf' WHEN '5-LOW' THEN 'official_web' ELSE 'unknown_web' END AS result_family,
  CASE p WHEN '1-URGENT' THEN 'clarity' WHEN '2-HIGH' THEN 'tabular_export' WHEN '3-MEDIUM' THEN 'document' WHEN '5-LOW' THEN 'official_web' ELSE 'results_portal' END AS queue_family,
  CASE p WHEN '1-URGENT' THEN 'clarity' ELSE 'unknown_web' END AS host_platform,
  CASE p WHEN '2-HIGH' THEN 'csv' ELSE 'unknown' END AS artifact_kind, p = '1-URGENT' AS is_clarity,
  CASE p WHEN '4-NOT SPECIFIED' THEN 'laserfiche' END AS dynamic_document,
  CASE p WHEN '1-URGENT' THEN 'execute_now' ELSE 'x' END = 'execute_now' AS runnable FROM o
""")
def platform_families(spark, sf_dir):
    p = F.col("o_orderpriority")
    url = (F.when(p == "1-URGENT", "https://results.enr.clarityelections.com/MI/1/2/")
           .when(p == "2-HIGH", "https://a.example.org/Results.csv")
           .when(p == "3-MEDIUM", "https://a.example.org/a.pdf")
           .when(p == "5-LOW", "https://a.example.gov/a")
           .otherwise("https://enr.example.org/laserfiche"))
    html = (F.when(p == "2-HIGH", "by ESSVote").when(p == "3-MEDIUM",
                                                     "Precincts Reported ... Summary Report")
            .when(p == "5-LOW", "Statement of Votes Cast").otherwise(""))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), url.alias("url"),
                                                 html.alias("html"))
    u = F.col("url")
    return rows.select(
        "k", C.page_platform(u, F.col("html")).alias("page_platform"),
        C.result_family(u, F.lit("")).alias("result_family"),
        C.queue_family(u)["family"].alias("queue_family"), C.host_platform(u)
        .alias("host_platform"), C.artifact_kind(u).alias("artifact_kind"),
        C.is_vendor("clarity", u).alias("is_clarity"), C.dynamic_document(u)
        .alias("dynamic_document"), (C.queue_family(u)["parser"] == "clarity").alias("runnable"))


@query("routes_and_grades", """
WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS p, o_orderstatus AS s, o_orderkey % 4 AS m FROM orders)
SELECT k, CASE p WHEN '1-URGENT' THEN 'clarity_xml' WHEN '2-HIGH' THEN 'structured_json' WHEN '3-MEDIUM' THEN 'scytl' ELSE 'x' END AS family,
  CASE WHEN s = 'P' THEN 'fetch_blocked' WHEN p IN ('1-URGENT', '2-HIGH') THEN 'execute_now' WHEN p = '3-MEDIUM' THEN 'discover_artifact' ELSE 'needs_platform_work' END AS action,
  CASE m WHEN 0 THEN 'A' WHEN 1 THEN 'E' WHEN 2 THEN 'D' ELSE 'C' END AS grade, m IN (1, 2) AS escalate,
  2 + CASE WHEN s = 'F' THEN 2 ELSE 0 END + 1 + CASE WHEN m = 3 THEN 1 ELSE 0 END AS priority,
  concat_ws(';', 'unverified', CASE WHEN s = 'F' THEN 'likely_official' END, 'legacy_http', CASE WHEN m = 3 THEN 'cycle_or_current_pointer' END) AS reasons,
  CASE WHEN s <> 'P' THEN 'ash' || CASE m WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' ELSE 'd' END END AS unit_name FROM o
""")
def routes_and_grades(spark, sf_dir):
    p, s, m = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey") % 4
    family = (F.when(p == "1-URGENT", "Clarity").when(p == "2-HIGH", "web")
              .when(p == "3-MEDIUM", "scytl").otherwise("x"))
    best = F.when(p == "1-URGENT", "xml").when(p == "2-HIGH", "json")
    route = C.readiness_route(family, best)
    status = (F.when(m == 0, "parsed").when(m == 1, "unreadable")
              .when(m == 2, "structurally_unresolved").otherwise("partial"))
    url = F.concat(F.lit("http://www.ash"), F.substr(F.lit("abcd"), m.cast("int") + 1, F.lit(1)),
                   F.lit("county.example.org/"), F.when(m == 3, "eid=4").otherwise(""))
    lead = C.verification_priority(url, F.lit("candidate"),
                                   F.when(s == "F", "likely_official").otherwise("unknown"))
    unit = C.inferred_unit(url, F.when(s == "P", "failed").otherwise("reached"), F.lit("county"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), route["family"].alias("family"),
        C.promotion_action(F.when(s != "P", "fetchable"), route["route"]).alias("action"),
        C.portability(status, F.lit(5), F.lit(2), F.lit(False)).alias("grade"),
        C.needs_escalation(status, F.lit(5), F.lit(0.001)).alias("escalate"),
        lead["priority"].alias("priority"), lead["reasons"].alias("reasons"),
        unit["name_token"].alias("unit_name"))


@query("link_keys", """
SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'P' THEN 'https://results.enr.clarityelections.com/MI/' || CAST(o_custkey AS VARCHAR) || '/7/'
  ELSE 'https://app.enhancedvoting.com/results/public/x/elections/' || CAST(o_custkey AS VARCHAR) || '?a=1' END AS publisher,
  'https://orig.example.org/' || CAST(o_orderkey AS VARCHAR) AS original, o_orderstatus = 'P' OR o_orderkey % 2 = 0 AS allowed, 2 AS parts FROM orders
""")
def link_keys(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    hosted = F.col("o_orderstatus") == "P"
    url = F.when(hosted, F.concat(F.lit("https://results.enr.clarityelections.com/MI/"), c,
                                  F.lit("/7/web/#/x"))).otherwise(
        F.concat(F.lit("https://app.enhancedvoting.com/results/public/x/elections/"), c,
                 F.lit("/detail?a=1")))
    archived = F.concat(F.lit("https://web.archive.org/web/20261103000000im_/"),
                        F.lit("https://orig.example.org/"), k)
    target = F.when(hosted, "https://x.clarityelections.com/").when(
        k % 2 == 0, "https://sub.seed.example.org/").otherwise("https://other.example.org/")
    return table(spark, sf_dir, "orders").select(
        k.alias("k"), U.publisher_key(url).alias("publisher"),
        U.archived_original(archived).alias("original"),
        U.allowed_link(F.lit("https://seed.example.org/a"), target).alias("allowed"),
        F.size(N.split_links(F.concat(c, F.lit(" |  | "), k))).alias("parts"))


@query("county_starts", """
WITH lo AS (SELECT DISTINCT c_nationkey AS st, 'place ' || CAST(c_custkey AS VARCHAR) AS nm FROM customer),
g AS (SELECT o_custkey % 25 AS st, 'place ' || CAST(o_custkey AS VARCHAR) AS nm, min(lpad(CAST(o_orderkey AS VARCHAR), 5, '0')) AS geo FROM orders GROUP BY ALL),
r AS (SELECT g.*, row_number() OVER (PARTITION BY g.st ORDER BY geo) AS rk FROM g LEFT JOIN lo ON lo.st = g.st AND lo.nm = g.nm WHERE lo.nm IS NULL AND g.st % 4 > 0)
SELECT 'us:' || CAST(r.st AS VARCHAR) || ':census-county:' || geo AS jurisdiction_id FROM r WHERE rk <= 40
""")
def county_starts(spark, sf_dir):
    lo = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("string").alias("state"),
        F.concat(F.lit("Place "), F.col("c_custkey"), F.lit(" County")).alias("canonical_name"))
    gz = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 25).cast("string").alias("USPS"),
        F.lpad(F.col("o_orderkey").cast("string"), 5, "0").alias("GEOID"),
        F.concat(F.lit("PLACE "), F.col("o_custkey"), F.lit(" Parish")).alias("NAME"))
    named = lo.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    de = table(spark, sf_dir, "nation").withColumn(
        "state", F.col("n_nationkey").cast("string")).join(named, "state", "left").select(
        "state", (F.coalesce("n", F.lit(0)) + 40).cast("int").alias("expected_primary_units"),
        F.when(F.col("n_nationkey") % 4 > 0, "county").otherwise("town").alias("authority_model"))
    return G.county_starts(gz, lo, de).select("jurisdiction_id")


@query("replay_checks", """
WITH o AS (SELECT DISTINCT 'region:' || CAST(n_regionkey AS VARCHAR) AS source_id, n_regionkey FROM nation)
SELECT source_id, n_regionkey % 2 = 1 AS altered, 0 AS double_counts FROM o
""")
def replay_checks(spark, sf_dir):
    facts = observations(spark, sf_dir).withColumns({
        c: F.lit(None).cast("string") for c in (
            "party", "raw_vote_mode", "source_order", "snapshot_sha256", "reporting_regime_id",
            "reporting_unit_raw_name", "reporting_unit_source_native_id")})
    captures = table(spark, sf_dir, "nation").select("n_regionkey").distinct().select(
        F.concat(F.lit("region:"), F.col("n_regionkey")).alias("source_id"),
        F.col("n_regionkey").cast("string").alias("body"),
        F.sha2((F.col("n_regionkey") + F.col("n_regionkey") % 2 * 100).cast("string"), 256)
        .alias("expected_sha256"))
    out = S.replay(facts, captures)
    double = out["double_counts"].groupBy("source_id").agg(F.count(F.lit(1)).alias("d"))
    kept = out["digest"].select("source_id", F.lit(False).alias("altered"))
    return kept.unionByName(out["altered"].select("source_id", F.lit(True).alias("altered"))).join(
        double, "source_id", "left").select(
        "source_id", "altered", F.coalesce("d", F.lit(0)).cast("int").alias("double_counts"))


@query("replay_refusals", """
WITH c AS (SELECT c_custkey AS k FROM customer),
f AS (SELECT k, 'snapshot_digest_mismatch' AS rule_id FROM c WHERE k % 7 = 0
  UNION ALL SELECT k, CASE k % 4 WHEN 2 THEN CASE WHEN k % 8 = 6 THEN 'identity_unresolved' ELSE 'identity_not_self' END ELSE 'identity_unresolved' END FROM c WHERE k % 4 >= 2
  UNION ALL SELECT k, 'night_regime_needs_night_source' FROM c WHERE k % 10 = 0
  UNION ALL SELECT k, 'final_regime_needs_final_source' FROM c WHERE k % 10 = 6)
SELECT 's' || CAST(k AS VARCHAR) AS source_id, rule_id, CAST(NULL AS BIGINT) AS row_count FROM f
UNION ALL SELECT 's' || CAST(o_custkey AS VARCHAR), 'digest', count(*) FROM orders JOIN c ON k = o_custkey WHERE o_custkey NOT IN (SELECT k FROM f) GROUP BY o_custkey
""")
def replay_refusals(spark, sf_dir):
    """Each customer is a capture with its orders as facts. A quarter resolves to another unit (and half of
    those to two), a quarter to none; dated aliases do not count."""
    k = F.col("c_custkey")
    own = table(spark, sf_dir, "customer")
    unit = F.concat(F.lit("j"), k)
    captures = own.select(
        F.concat(F.lit("s"), k).alias("source_id"), unit.alias("jurisdiction_id"),
        k.cast("string").alias("body"),
        F.sha2((k + F.when(k % 7 == 0, 1).otherwise(0)).cast("string"), 256).alias("expected_sha256"),
        F.when(k % 5 == 0, "election-night").when(k % 5 == 1, "certified").otherwise("other")
        .alias("regime_kind"),
        F.when(k % 10 < 5, "final").otherwise("election_night").alias("capability_type"))
    row = lambda to, since: F.struct(to.alias("canonical_id"),
                                     F.lit(since).cast("date").alias("effective_from"))
    rows = F.array_compact(F.array(
        F.when(k % 4 < 2, row(unit, None)), F.when(k % 4 == 2, row(F.lit("x"), None)),
        F.when(k % 8 == 6, row(unit, None)), row(F.lit("y"), "2020-01-01")))
    aliases = own.select(unit.alias("_u"), F.inline(rows)).select(
        F.lit("jurisdiction").alias("object_type"), F.lit("Replay ").alias("alias_namespace"),
        F.upper("_u").alias("alias_value"), "canonical_id", F.lit("verified").alias("status"),
        "effective_from", F.lit(None).cast("date").alias("effective_to"))
    blank = F.lit(None).cast("string")
    facts = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("s"), F.col("o_custkey")).alias("source_id"), F.lit("e").alias("election_id"),
        F.lit("us:j").alias("jurisdiction_id"),
        F.col("o_orderkey").cast("string").alias("reporting_unit_id"),
        F.lit("r").alias("contest_name"), F.lit("c").alias("choice_name"), F.lit("total").alias("vote_mode"),
        F.col("o_orderkey").alias("votes"), *[blank.alias(c) for c in (
            "party", "raw_vote_mode", "source_order", "snapshot_sha256", "reporting_regime_id",
            "reporting_unit_raw_name", "reporting_unit_source_native_id")])
    out = S.replay(facts, captures, aliases=aliases)
    found = out["altered"].unionByName(out["identity"]).unionByName(out["regime"])
    none = F.lit(None).cast("long")
    return found.withColumn("row_count", none).unionByName(out["digest"].select(
        "source_id", F.lit("digest").alias("rule_id"), "row_count"))


@query("execution_evidence", """
WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS p, CASE WHEN o_orderpriority < '2' OR o_orderpriority LIKE '3%'
    THEN (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) ELSE 0 END AS n FROM orders)
SELECT k, CASE p WHEN '1-URGENT' THEN 'nested_json' WHEN '2-HIGH' THEN 'download_links' WHEN '3-MEDIUM' THEN 'wide_csv' WHEN '4-NOT SPECIFIED' THEN 'nested_json' ELSE 'unknown' END AS parser,
  CASE p WHEN '2-HIGH' THEN 2 WHEN '5-LOW' THEN 3 WHEN '4-NOT SPECIFIED' THEN 3 ELSE CASE WHEN n > 0 THEN 6 ELSE 4 END END AS stage, n AS observation_count,
  CASE WHEN n > 0 THEN p LIKE '3%' END AS vote_modes_preserved,
  CASE p WHEN '2-HIGH' THEN 'requires_download_artifact_selection' WHEN '5-LOW' THEN 'parser_not_executable' WHEN '4-NOT SPECIFIED' THEN 'invalid_json_payload'
    ELSE CASE WHEN n > 0 THEN '' ELSE 'no_normalized_observations' END END AS failure_class FROM o
""")
def execution_evidence(spark, sf_dir):
    """Each order is a capture of its lines, as JSON or CSV, or of another body, by its priority."""
    p, v = F.col("o_orderpriority"), F.col("l_quantity").cast("long")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct(
        F.concat(F.lit('{"name":"c'), F.col("l_linenumber"), F.lit('","votes":'), v, F.lit("}"))
        .alias("json"), F.concat(F.lit("u,r,c"), F.col("l_linenumber"), F.lit(","), v).alias("csv"))
        .alias("x")).groupBy("l_orderkey").agg(F.collect_list("x").alias("x"))
    o = table(spark, sf_dir, "orders").join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    x = F.coalesce("x", F.array().cast("array<struct<json:string,csv:string>>"))
    json_ = F.concat(F.lit(' {"reporting_units":[{"name":"u","contests":[{"name":"r","choices":['),
                     F.array_join(x["json"], ","), F.lit("]}]}]}"))
    csv = F.concat(F.lit("precinct,race,choice,mail\n"), F.array_join(x["csv"], "\n"))
    captures = o.select(
        F.lit("x").alias("state"), F.col("o_orderkey").cast("string").alias("result_url"),
        F.lit("web").alias("access_family"),
        F.when(p == "2-HIGH", "download_links").when(p == "4-NOT SPECIFIED", "nested_json")
        .otherwise("unknown").alias("route"),
        F.when(p == "1-URGENT", json_).when(p == "3-MEDIUM", csv).otherwise("zz").cast("binary")
        .alias("content"), F.lit("unknown").alias("smallest_observed_unit"))
    ctx = R.Context(F.lit("2026"), F.lit("us:mi:county:x"), F.col("result_url"),
                    F.lit("2026-11-03").cast("timestamp"), F.lit("certified"),
                    F.sha2("content", 256))
    return D.execute(captures, ctx)[0].select(
        F.col("result_url").cast("long").alias("k"), "parser", "stage", "observation_count",
        "vote_modes_preserved", "failure_class")


@query("capture_replay", """
SELECT o_orderkey % 5 = 0 AS altered, count(*) AS pages FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL
""")
def capture_replay(spark, sf_dir):
    pages = captured_pages(spark, sf_dir)
    digest = F.when(F.col("page_id") % 5 == 0, "0").otherwise(F.sha2("html", 256))
    good, bad = K.replayable_pages(pages.withColumn("snapshot_sha256", digest))
    return good.select(F.lit(False).alias("altered")).unionByName(
        bad.select(F.lit(True).alias("altered"))).groupBy("altered").agg(
        F.count(F.lit(1)).alias("pages"))
