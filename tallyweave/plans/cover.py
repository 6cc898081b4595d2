"""Queries over coverage, catalogs and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.operators import catalog as K, coverage as V, links as L
from tallyweave.operators.ordered import priority_queue
from tallyweave.plans.registry import ORACLES, QUERIES, query
from tallyweave.plans.views import CP_SQL, captured_pages, table

# Customers are units of a nation; orders are dated capabilities of customers.
_C_SQL = """
lo AS (SELECT c_custkey AS id, 'n' || CAST(c_nationkey AS VARCHAR) AS state, c_mktsegment AS seg,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'known_missing_source' ELSE 'enumerated_unresolved' END AS cs FROM customer),
de AS (SELECT 'n' || CAST(n_nationkey AS VARCHAR) AS state, n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey)
         + n_nationkey % 5 - 1 AS expected, CASE WHEN n_nationkey % 3 = 0 THEN 'high_confidence' ELSE 'provisional' END AS est FROM nation),
ca AS (SELECT o_custkey AS id, CASE WHEN o_orderpriority < '3' THEN 'final' ELSE 'election_night' END AS ct,
         o_orderstatus, CAST(o_orderdate AS DATE) AS vf, o_orderpriority, o_orderkey FROM orders),
dc AS (SELECT id, bool_or(ct = 'final') AS f, bool_or(ct = 'election_night') AS l FROM ca
       WHERE o_orderstatus <> 'P' AND vf <= DATE '1999-06-01' AND DATE '1999-06-01' <= vf + 900 GROUP BY ALL),
ov AS (SELECT lo.*, CASE WHEN f AND l THEN 'both' WHEN f THEN 'final_only' WHEN l THEN 'election_night_only'
         WHEN cs = 'known_missing_source' THEN cs ELSE 'enumerated_unresolved' END AS st FROM lo LEFT JOIN dc USING (id))
"""


def _base(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    state = F.concat(F.lit("n"), F.col("c_nationkey"))
    lo = c.select(
        F.col("c_custkey").alias("jurisdiction_id"), state.alias("state"),
        F.col("c_mktsegment").alias("jurisdiction_level"), F.col("c_name").alias("canonical_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "known_missing_source")
        .otherwise("enumerated_unresolved").alias("coverage_status"))
    n = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey")
    de = nation.join(n, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        F.concat(F.lit("n"), F.col("n_nationkey")).alias("state"),
        (F.coalesce("n", F.lit(0)) + F.col("n_nationkey") % 5 - 1).alias("expected_primary_units"),
        F.when(F.col("n_nationkey") % 3 == 0, "high_confidence").otherwise("provisional")
        .alias("estimate_status"))
    day = F.to_date("o_orderdate")
    ca = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("jurisdiction_id"), "o_orderkey",
        F.when(F.col("o_orderpriority") < "3", "final").otherwise("election_night")
        .alias("capability_type"),
        F.when(F.col("o_orderstatus") == "P", "candidate").otherwise("verified")
        .alias("verification_status"), F.col("o_orderpriority").alias("platform_family"),
        F.when(F.col("o_orderstatus") == "F", "precinct").alias("smallest_observed_unit"),
        day.alias("valid_from"), F.date_add(day, 900).alias("valid_to"))
    return lo, de, ca


@query("derived_capabilities", f"""
WITH {_C_SQL} SELECT id AS jurisdiction_id, f AS final, l AS live FROM dc
""")
def derived_capabilities(spark, sf_dir):
    return V.derived_capabilities(_base(spark, sf_dir)[2], F.lit("1999-06-01").cast("date"))


_COUNTS = ", ".join(f"count(*) FILTER (st = '{s}') AS {s}" for s in V.STATUSES)
_SUMS = ", ".join(f"CAST(sum({s}) AS BIGINT) AS {s}" for s in V.STATUSES)


@query("coverage_tracker", f"""
WITH {_C_SQL},
k AS (SELECT state, {_COUNTS} FROM ov GROUP BY ALL),
j AS (SELECT de.state, expected, {", ".join(f"coalesce({s}, 0) AS {s}" for s in V.STATUSES)} FROM de LEFT JOIN k USING (state)),
u AS (SELECT * FROM j UNION ALL SELECT 'US', CAST(sum(expected) AS BIGINT), {_SUMS} FROM j)
SELECT state, expected AS expected_primary_units, {", ".join(V.STATUSES)},
  expected - enumerated_unresolved - final_only - election_night_only - "both" - known_missing_source AS estimated_unknown_units,
  final_only + election_night_only + "both" AS with_any_source, final_only + "both" AS with_final,
  election_night_only + "both" AS with_election_night,
  enumerated_unresolved + final_only + election_night_only + "both" + known_missing_source > expected AS overrun FROM u
""".replace("AS both", 'AS "both"').replace("sum(both)", 'sum("both")').replace("coalesce(both", 'coalesce("both"').replace(" both,", ' "both",'))
def coverage_tracker(spark, sf_dir):
    lo, de, ca = _base(spark, sf_dir)
    caps = V.derived_capabilities(ca, F.lit("1999-06-01").cast("date"))
    return V.coverage_tracker(V.overlay_status(lo, caps), de)


@query("tracker_violations", f"""
WITH {_C_SQL},
k AS (SELECT state, count(*) AS n FROM lo GROUP BY ALL)
SELECT de.state FROM de LEFT JOIN k USING (state) WHERE expected - coalesce(n, 0) < 0 OR expected < 0
""")
def tracker_violations(spark, sf_dir):
    lo, de, _ = _base(spark, sf_dir)
    return V.tracker_violations(V.coverage_tracker(lo, de, national=False))


def _hist(col, src, name):
    return f"""{name} AS (SELECT state, string_agg(v || ':' || CAST(n AS VARCHAR), '|' ORDER BY v) AS h FROM
      (SELECT state, {col} AS v, count(*) AS n FROM {src} GROUP BY ALL) GROUP BY ALL)"""


@query("unit_census", f"""
WITH {_C_SQL}, cj AS (SELECT ca.*, state FROM ca JOIN lo USING (id)),
{_hist("seg", "lo", "h1")}, {_hist("CASE WHEN o_orderstatus = 'F' THEN 'precinct' ELSE 'unknown' END", "cj", "h2")},
{_hist("ct", "cj", "h3")}, {_hist("o_orderpriority", "cj", "h4")},
k AS (SELECT state, count(*) AS n FROM lo GROUP BY ALL)
SELECT de.state, expected AS expected_primary_units, coalesce(k.n, 0) AS enumerated_primary_units,
  coalesce(h1.h, 'none') AS administrative_levels, coalesce(h2.h, 'none') AS observed_reporting_units,
  coalesce(h3.h, 'none') AS capability_types, coalesce(h4.h, 'none') AS data_access_families
FROM de LEFT JOIN k USING (state) LEFT JOIN h1 USING (state) LEFT JOIN h2 USING (state) LEFT JOIN h3 USING (state) LEFT JOIN h4 USING (state)
""")
def unit_census(spark, sf_dir):
    lo, de, ca = _base(spark, sf_dir)
    ca = ca.join(lo.select("jurisdiction_id", "state"), "jurisdiction_id")
    return V.unit_census(de, lo, ca)


# Orders as authority rows with result links built from their line items' parts.
_A_SQL = """
au AS (SELECT o_orderkey, 'n' || CAST(c_nationkey AS VARCHAR) AS state, o_orderstatus, o_orderpriority,
  'https://r' || CAST(o_orderkey % 40 AS VARCHAR) || CASE o_orderpriority WHEN '1-URGENT' THEN '.clarityelections.com/a'
    WHEN '2-HIGH' THEN '.example.org/x.csv' WHEN '3-MEDIUM' THEN '.example.org/y.pdf' WHEN '5-LOW' THEN '.example.gov/z' ELSE '.example.org/scytl' END AS u1,
  'https://r' || CAST(o_orderkey % 30 AS VARCHAR) || '.example.org/documents' AS u2
  FROM orders JOIN customer ON o_custkey = c_custkey ),
li AS (SELECT state, u, min(o_orderkey) AS k, arg_min(o_orderstatus, o_orderkey) AS s FROM (
  SELECT state, u1 AS u, o_orderkey, o_orderstatus FROM au UNION ALL
  SELECT state, u2, o_orderkey, o_orderstatus FROM au WHERE o_orderstatus <> 'F') GROUP BY ALL),
lf AS (SELECT *, CASE WHEN u LIKE '%clarityelections%' THEN 'clarity' WHEN u LIKE '%scytl%' THEN 'scytl' WHEN u LIKE '%.csv%' THEN 'tabular_download'
  WHEN u LIKE '%.pdf%' THEN 'pdf' WHEN u LIKE '%.example.gov/%' THEN 'official_web' ELSE 'unknown_web' END AS fam FROM li),
lt AS (SELECT *, CASE fam WHEN 'clarity' THEN 'ready_adapter' WHEN 'tabular_download' THEN 'ready_adapter' WHEN 'scytl' THEN 'needs_adapter_completion'
  WHEN 'pdf' THEN 'document_adapter' ELSE 'unsupported_web' END AS tier FROM lf)
"""


def _authority_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    p = F.col("o_orderpriority")
    tail = (F.when(p == "1-URGENT", ".clarityelections.com/a")
            .when(p == "2-HIGH", ".example.org/x.csv").when(p == "3-MEDIUM", ".example.org/y.pdf")
            .when(p == "5-LOW", ".example.gov/z").otherwise(".example.org/scytl"))
    u1 = F.concat(F.lit("https://r"), F.col("o_orderkey") % 40, tail)
    u2 = F.concat(F.lit("https://r"), F.col("o_orderkey") % 30,
                  F.lit(".example.org/documents"))
    links = F.when(F.col("o_orderstatus") == "F", u1).otherwise(F.concat(u1, F.lit(" | "), u2))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.concat(F.lit("n"), F.col("c_nationkey")).alias("state"),
        F.concat(F.lit("https://a"), F.col("o_orderkey") % 50, F.lit(".example.gov/"))
        .alias("authority_url"),
        F.concat(F.lit("a"), F.col("o_orderkey") % 50, F.lit(".example.gov"))
        .alias("authority_host"),
        links.alias("result_links"),
        F.when(F.col("o_orderstatus") == "F", "True").otherwise("false")
        .alias("election_night_candidate"),
        F.when(p < "3", "precinct").otherwise("").alias("smallest_observed_unit"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("reached").alias("status"),
        p.alias("platform_family"))


@query("link_candidates", f"""
WITH {_A_SQL}
SELECT upper(state) AS state, u AS result_url, fam AS access_family, tier AS ingest_tier,
  CASE s WHEN 'F' THEN 'True' ELSE 'false' END AS election_night_candidate FROM lt
""")
def link_candidates(spark, sf_dir):
    out = V.link_candidates(_authority_rows(spark, sf_dir), "o_orderkey")
    return out.select("state", "result_url", "access_family", "ingest_tier",
                      "election_night_candidate")


@query("family_summary", f"""
WITH {_A_SQL}, {_C_SQL},
s AS (SELECT DISTINCT tier, fam, state FROM lt)
SELECT tier AS ingest_tier, fam AS access_family, (SELECT count(*) FROM lt WHERE lt.tier = s.tier AND lt.fam = s.fam) AS unique_result_urls,
  string_agg(upper(s.state), '|' ORDER BY upper(s.state)) AS states, count(*) AS state_count, CAST(sum(expected) AS BIGINT) AS expected_units_exposed
FROM s JOIN de ON de.state = s.state GROUP BY ALL
""")
def family_summary(spark, sf_dir):
    de = _base(spark, sf_dir)[1].withColumn("state", F.upper("state"))
    return V.family_summary(V.link_candidates(_authority_rows(spark, sf_dir), "o_orderkey"), de)


@query("supported_manifest", f"""
WITH {_A_SQL}
SELECT upper(state) AS state, u AS result_url, CASE fam WHEN 'clarity' THEN 'download_links' ELSE 'wide_csv' END AS parser
FROM lt WHERE tier = 'ready_adapter'
""")
def supported_manifest(spark, sf_dir):
    rows = V.link_candidates(_authority_rows(spark, sf_dir), "o_orderkey")
    return V.supported_manifest(rows).select("state", "result_url", "parser")


@query("near_ready", f"""
WITH {_A_SQL}
SELECT upper(state) AS state, u AS result_url, 'adapter_completion' AS promotion_blocker FROM lt WHERE tier = 'needs_adapter_completion'
""")
def near_ready(spark, sf_dir):
    rows = V.link_candidates(_authority_rows(spark, sf_dir), "o_orderkey")
    return V.near_ready(rows).select("state", "result_url", "promotion_blocker")


@query("host_priority", r"""
WITH h AS (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(html, 'lang="([a-z]*)"', 1) AS st, page_id, url, page_id % 7 = 0 AS night FROM pages)
SELECT host AS result_host, count(*) AS candidate_count, (SELECT string_agg(DISTINCT h2.st, '|' ORDER BY h2.st) FROM h h2 WHERE h2.host = h.host) AS states,
  count(*) FILTER (night) AS election_night_candidate_count, arg_min(url, page_id) AS sample_url FROM h GROUP BY host
""")
def host_priority(spark, sf_dir):
    from tallyweave.functions import urls as U
    pages = table(spark, sf_dir, "pages")
    rows = pages.select(
        "page_id", U.host(F.col("url")).alias("result_host"), F.col("url").alias("result_url"),
        F.regexp_extract("html", 'lang="([a-z]*)"', 1).alias("state"),
        (F.col("page_id") % 7 == 0).cast("string").alias("election_night_candidate"))
    return V.host_priority(rows, "page_id")


@query("promotion_summary", f"""
WITH {_A_SQL},
f AS (SELECT state, o_orderkey % 50 AS a, arg_min(o_orderstatus, o_orderkey) AS s, arg_min(o_orderpriority, o_orderkey) AS p FROM au
      WHERE o_orderstatus <> 'P' GROUP BY ALL),
k AS (SELECT state, count(*) AS r, count(*) FILTER (s = 'F') AS nt, count(*) FILTER (p < '3') AS fine FROM f GROUP BY ALL)
SELECT 'n' || CAST(n_nationkey AS VARCHAR) AS state, coalesce(r, 0) AS reached_surfaces, coalesce(r, 0) AS surfaces_with_result_links,
  coalesce(nt, 0) AS election_night_candidates, coalesce(fine, 0) AS precinct_or_finer_surfaces
FROM nation LEFT JOIN k ON k.state = 'n' || CAST(n_nationkey AS VARCHAR)
""")
def promotion_summary(spark, sf_dir):
    states = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("n"), F.col("n_nationkey")).alias("state"))
    return V.promotion_summary(_authority_rows(spark, sf_dir), states, "o_orderkey")


@query("state_gaps", f"""
WITH {_A_SQL}, {_C_SQL},
fm AS (SELECT state, string_agg(o_orderpriority || ':' || CAST(n AS VARCHAR), '|' ORDER BY n DESC, o_orderpriority) AS h FROM
  (SELECT state, o_orderpriority, count(*) AS n FROM au GROUP BY ALL) GROUP BY ALL),
k AS (SELECT state, count(*) AS n, count(*) FILTER (o_orderstatus <> 'P') AS r, count(*) FILTER (o_orderstatus = 'F') AS nt FROM au GROUP BY ALL)
SELECT de.state, coalesce(k.n, 0) AS discovered_rows, coalesce(r, 0) AS reached_authorities, coalesce(k.n, 0) AS rows_with_result_links,
  coalesce(nt, 0) AS election_night_candidates, coalesce(h, '') AS discovered_families, expected AS expected_primary_units,
  CASE WHEN n_nationkey % 2 = 0 THEN 5 ELSE 0 END AS enumerated_primary_units,
  CASE WHEN n_nationkey % 2 = 0 THEN 'canonicalized' WHEN r > 0 THEN 'promote_discovered_sources' ELSE 'resolve_central_directory' END AS phase
FROM de LEFT JOIN k USING (state) LEFT JOIN fm USING (state)
""")
def state_gaps(spark, sf_dir):
    de = _base(spark, sf_dir)[1]
    even = F.substring("state", 2, 9).cast("int") % 2 == 0
    census = de.withColumn("enumerated_primary_units", F.when(even, 5).otherwise(0))
    return V.state_gaps(_authority_rows(spark, sf_dir), census)


_STAGE = ("CASE WHEN l_quantity < 8 THEN 'discovered' WHEN l_quantity < 15 THEN 'fetchable' WHEN l_quantity < 22 THEN 'parser_selected' "
          "WHEN l_quantity < 29 THEN 'parse_executed' WHEN l_quantity < 36 THEN 'normalized' WHEN l_quantity < 43 THEN 'replay_tested' ELSE 'refresh_verified' END")


def _execution(spark, sf_dir):
    q = F.col("l_quantity")
    stage = (F.when(q < 8, "discovered").when(q < 15, "fetchable").when(q < 22, "parser_selected")
             .when(q < 29, "parse_executed").when(q < 36, "normalized")
             .when(q < 43, "replay_tested").otherwise("refresh_verified"))
    fail = (F.when(F.col("l_returnflag") == "A", "http_404")
            .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"),
                  "invalid_json_payload").otherwise(""))
    fam = F.when(F.col("l_linenumber") < 3, "clarity").otherwise("pdf")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey")).alias("state"), stage.alias("execution_stage"),
        fail.alias("failure_class"), fam.alias("access_family"))


@query("stage_depth", f"""
WITH e AS (SELECT 's' || CAST(l_suppkey AS VARCHAR) AS state, {_STAGE} AS st, l_quantity AS q, l_returnflag = 'A' OR (l_returnflag = 'R' AND l_linestatus = 'F') AS bad FROM lineitem)
SELECT state, count(*) AS sources_attempted, count(*) FILTER (bad) AS failures, count(*) FILTER (q >= 15) AS parser_selected_or_higher,
  count(*) FILTER (q >= 29) AS normalized_or_higher, count(*) FILTER (q >= 36) AS replay_tested_or_higher, count(*) FILTER (q >= 43) AS refresh_verified,
  arg_max(st, q) AS highest_execution_stage FROM e GROUP BY ALL
""")
def stage_depth(spark, sf_dir):
    return V.depth_summary(_execution(spark, sf_dir))


@query("residual_summary", f"""
WITH e AS (SELECT {_STAGE} AS st, l_returnflag AS rf, l_linestatus AS ls, CASE WHEN l_linenumber < 3 THEN 'clarity' ELSE 'pdf' END AS fam FROM lineitem),
c AS (SELECT fam, CASE WHEN rf = 'A' THEN 'fetch_hardening' WHEN rf = 'R' AND ls = 'F' THEN 'schema_adaptation'
  WHEN st IN ('normalized', 'replay_tested', 'refresh_verified') THEN 'complete' WHEN st = 'parser_selected' THEN 'parser_followup'
  WHEN fam = 'clarity' THEN 'known_family_followup' ELSE 'unclassified_followup' END AS k FROM e)
SELECT k AS residual_class, fam AS access_family, count(*) AS source_count, CASE k WHEN 'complete' THEN 0 WHEN 'known_family_followup' THEN 5
  WHEN 'schema_adaptation' THEN 4 WHEN 'fetch_hardening' THEN 3 ELSE 2 END AS priority FROM c GROUP BY ALL
""")
def residual_summary(spark, sf_dir):
    return V.residual_summary(_execution(spark, sf_dir))


@query("readiness_summary", """
SELECT CASE WHEN o_orderstatus = 'P' THEN 'fetch_blocked' WHEN o_orderpriority = '1-URGENT' THEN 'execute_existing_adapter'
  WHEN o_orderpriority = '2-HIGH' THEN 'artifact_discovery' WHEN o_orderpriority = '3-MEDIUM' THEN 'new_platform_adapter'
  ELSE 'platform_probe_followup' END AS next_action, count(*) AS source_count FROM orders GROUP BY ALL
""")
def readiness_summary(spark, sf_dir):
    p = F.col("o_orderpriority")
    rows = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", "fetchable").alias("fetch_status"),
        F.when(p == "1-URGENT", "clarity").when(p == "3-MEDIUM", "scytl").otherwise("x")
        .alias("platform_family"),
        F.when(p == "2-HIGH", "https://e.example.org/a.csv").alias("discovered_artifacts"))
    return V.readiness_summary(rows)


@query("state_readiness", f"""
WITH {_C_SQL},
f AS (SELECT lo.id, state, id IN (SELECT o_custkey FROM orders WHERE o_orderkey % 11 = 0) AS d, id IN (SELECT o_custkey FROM orders WHERE o_orderkey % 13 = 0) AS l,
        id IN (SELECT o_custkey FROM orders WHERE o_orderkey % 17 = 0) AS v, CAST(substr(state, 2) AS INT) % 4 > 0 AS c FROM lo),
k AS (SELECT state, count(*) AS n, count(*) FILTER (d OR c) AS a, count(*) FILTER (d) AS d, count(*) FILTER (l) AS l, count(*) FILTER (d OR l) AS dl,
        count(*) FILTER ((d OR c) AND NOT (d OR l)) AS fb, count(*) FILTER (v) AS v FROM f GROUP BY ALL),
r AS (SELECT de.state, expected AS expected_primary_units, est AS estimate_status, coalesce(n, 0) AS named_units, coalesce(a, 0) AS units_with_any_start,
        coalesce(d, 0) AS units_with_direct_evidence, coalesce(l, 0) AS units_with_search_candidates, coalesce(dl, 0) AS units_with_any_direct_candidate,
        coalesce(fb, 0) AS fallback_only_units, coalesce(v, 0) AS verified_units, greatest(0, expected - coalesce(n, 0)) AS unnamed_units,
        greatest(0, coalesce(n, 0) - expected) AS denominator_overrun FROM de LEFT JOIN k USING (state))
SELECT * FROM r UNION ALL SELECT 'US', CAST(sum(expected_primary_units) AS BIGINT), 'provisional', CAST(sum(named_units) AS BIGINT), CAST(sum(units_with_any_start) AS BIGINT),
  CAST(sum(units_with_direct_evidence) AS BIGINT), CAST(sum(units_with_search_candidates) AS BIGINT), CAST(sum(units_with_any_direct_candidate) AS BIGINT),
  CAST(sum(fallback_only_units) AS BIGINT), CAST(sum(verified_units) AS BIGINT), CAST(sum(unnamed_units) AS BIGINT), CAST(sum(denominator_overrun) AS BIGINT) FROM r
""")
def state_readiness(spark, sf_dir):
    lo, de, _ = _base(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("jurisdiction_id"),
                                              "o_orderkey")
    some = lambda k: o.filter(F.col("o_orderkey") % k == 0)
    central = de.filter(F.substring("state", 2, 9).cast("int") % 4 > 0)
    return V.readiness(de, lo, some(11), some(13), some(17), central)


@query("start_audit", f"""
WITH {_C_SQL},
s AS (SELECT o_custkey AS id, bool_or(o_orderstatus <> 'P') AS own FROM orders GROUP BY ALL),
k AS (SELECT state, count(*) AS n, count(own) AS a, count(*) FILTER (coalesce(own, false)) AS d FROM lo LEFT JOIN s USING (id) GROUP BY ALL)
SELECT de.state, expected AS expected_primary_units, est AS estimate_status, coalesce(n, 0) AS named_units, coalesce(a, 0) AS units_with_any_start,
  coalesce(d, 0) AS units_with_direct_lead, greatest(0, expected - coalesce(n, 0)) AS unnamed_units, coalesce(n, 0) - coalesce(a, 0) AS named_units_without_start,
  coalesce(n, 0) = expected AND coalesce(n, 0) = coalesce(a, 0) AND est = 'high_confidence' AS complete FROM de LEFT JOIN k USING (state)
""")
def start_audit(spark, sf_dir):
    lo, de, _ = _base(spark, sf_dir)
    starts = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("jurisdiction_id"),
        F.when(F.col("o_orderstatus") == "P", "state_directory_fallback").otherwise("own")
        .alias("page_role"))
    return V.start_audit(de, lo, starts)


@query("portability_shares", """
WITH c AS (SELECT substr('ABCDE', CAST(substr(o_orderpriority, 1, 1) AS INT), 1) AS p FROM orders),
k AS (SELECT count(*) AS n, count(*) FILTER (p = 'A') AS a, count(*) FILTER (p = 'B') AS b, count(*) FILTER (p = 'C') AS c, count(*) FILTER (p = 'D') AS d, count(*) FILTER (p = 'E') AS e FROM c)
SELECT n AS counties, a AS "A", b AS "B", c AS "C", d AS "D", e AS "E", (a + b) / n AS a_or_b_share, (a + b + c) / n AS a_b_or_c_share FROM k
""")
def portability_shares(spark, sf_dir):
    grade = F.substr(F.lit("ABCDE"), F.left("o_orderpriority", F.lit(1)).cast("int"), F.lit(1))
    return V.portability_shares(table(spark, sf_dir, "orders").select(
        grade.alias("portability_class")))


@query("column_inventory", """
SELECT count(*) AS row_count, count(DISTINCT nullif(trim(event_type), '')) AS distinct_labels, 'votes|total' AS vote_columns FROM events
""")
def column_inventory(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_type", F.col("value").alias("Votes"), F.col("user_id").alias(" total "))
    return V.column_inventory(rows, "event_type", ["early", "votes", "total"])


@query("observed_units", """
SELECT DISTINCT o_orderpriority AS county, 'Ward ' || CAST(o_custkey AS VARCHAR) AS raw_label,
  substr(sha256('src' || chr(31) || 'e1' || chr(31) || o_orderpriority || chr(31) || 'Ward ' || CAST(o_custkey AS VARCHAR)), 1, 20) AS observed_reporting_unit_id FROM orders
""")
def observed_units(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("county"),
        F.concat(F.lit("Ward "), F.col("o_custkey"), F.lit(" ")).alias("Precinct"))
    return V.observed_units(rows, "county", V.precinct_column(rows.columns), "src", "e1")


@query("modes_preserved", """
SELECT l_suppkey AS source_id, count(*) AS observation_count, bool_or(l_linestatus = 'F' AND l_suppkey % 3 > 0) AS vote_modes_preserved FROM lineitem GROUP BY ALL
""")
def modes_preserved(spark, sf_dir):
    raw = F.when((F.col("l_linestatus") == "F") & (F.col("l_suppkey") % 3 > 0), "mail").otherwise(
        F.when(F.col("l_linenumber") > 3, "total"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source_id"),
                                                   raw.alias("raw_vote_mode"))
    return V.modes_preserved(rows, ["source_id"])


@query("geography_ledger", """
SELECT c_custkey AS jurisdiction_id, c_nationkey AS state, (c_acctbal > 0)::INT + (c_custkey % 4 = 0)::INT AS source_count,
  CASE WHEN c_acctbal > 0 OR c_custkey % 4 = 0 THEN 'resolved' ELSE 'unresolved' END AS search_status,
  c_name || ' ' || CAST(c_nationkey AS VARCHAR) || ' election results' AS search_query,
  (c_acctbal > 0)::INT + (c_custkey % 4 = 0)::INT AS leads FROM customer
""")
def geography_ledger(spark, sf_dir):
    lo = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("jurisdiction_id"), F.col("c_nationkey").alias("state"),
        F.col("c_name").alias("canonical_name"),
        F.when(F.col("c_acctbal") > 0, "https://f.example.org").otherwise("")
        .alias("final_evidence_url"),
        F.when(F.col("c_custkey") % 4 == 0, "https://n.example.org")
        .alias("election_night_evidence_url"))
    leads = V.source_leads(lo).groupBy("jurisdiction_id").agg(
        F.count(F.lit(1)).cast("int").alias("leads"))
    return V.geography_ledger(lo).join(leads, "jurisdiction_id", "left").fillna(0, ["leads"])


@query("pending_buckets", """
SELECT CASE WHEN o_orderstatus = 'P' THEN 'authority_fetch_failed' WHEN o_orderpriority = '1-URGENT' THEN 'authority_unresolved'
  WHEN o_orderkey % 2 = 0 THEN 'authority_resolved_no_result_artifact' ELSE 'artifact_needs_followup' END AS bucket, count(*) AS cases
FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL
""")
def pending_buckets(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, "pending").otherwise("A").alias("portability"),
        F.when(F.col("o_orderstatus") == "P", "Fetch_Failed").alias("authority_status"),
        F.when(F.col("o_orderpriority") != "1-URGENT", "https://a").alias("authority_url"),
        F.when(F.col("o_orderkey") % 2 == 1, "https://b").alias("artifact_url"))
    return V.pending_buckets(rows)


@query("corpus_gaps", """
WITH s AS (SELECT c_nationkey AS state, count(*) AS n FROM customer GROUP BY ALL),
x AS (SELECT state, n % 3 AS lead_count, state % 4 AS h, state % 3 AS a, state % 5 AS c, state % 2 = 0 AS sc, state % 6 = 0 AS own FROM s),
y AS (SELECT *, CASE WHEN h = 0 THEN greatest(1, lead_count) ELSE 0 END + (a = 0)::INT + (c = 0)::INT + sc::INT + own::INT AS k FROM x),
z AS (SELECT *, k = 0 AND (h = 1 OR a <> 0 OR c IN (1, 2)) AS sec FROM y)
SELECT state, k AS official_candidate_count, sec AS secondary_only,
  CAST(3 * (k = 0)::INT + 2 * sec::INT + (h = 3)::INT + (c = 3)::INT AS BIGINT) AS gap_priority,
  coalesce(nullif(concat_ws(';', CASE WHEN h = 3 THEN 'harvest_no_url' END, CASE WHEN a <> 0 THEN 'archive_nonprimary' END,
    CASE WHEN c = 3 THEN 'cited_no_direct_link' WHEN c IN (1, 2) THEN 'cited_secondary' END, CASE WHEN NOT sc THEN 'no_live_scraper' END,
    CASE WHEN sec THEN 'secondary_only' END), ''), 'none') AS gap_reasons FROM z
""")
def corpus_gaps(spark, sf_dir):
    s = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("state")).agg(
        F.count(F.lit(1)).alias("n"))
    k = F.col("state")
    harvest = s.select(
        "state", (F.col("n") % 3).alias("lead_count"),
        F.when(k % 4 == 0, "direct_official_url").when(k % 4 == 1, "secondary_source")
        .otherwise("other").alias("harvest_status"),
        F.when(k % 4 != 3, "https://h.example.org").alias("source_url"))
    archive = s.select("state", F.when(k % 3 == 0, "official_candidate").otherwise("other")
                       .alias("source_class"))
    cited = s.select("state", F.when(k % 5 == 0, "official_candidate")
                     .when(k % 5 == 1, "secondary_repository").when(k % 5 == 2, "secondary_source")
                     .when(k % 5 == 3, "no_direct_source_link").otherwise("other")
                     .alias("source_class"))
    own = s.select("state", F.when(k % 6 == 0, "https://o.example.org").alias("result_url"))
    return V.corpus_gaps(harvest, archive, cited, s.filter(k % 2 == 0), own)


@query("depth_matrix", f"""
WITH {_C_SQL},
ex AS (SELECT 'n' || CAST(s_nationkey AS VARCHAR) AS state, l_quantity AS q, {_STAGE} AS st FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
e2 AS (SELECT state, count(*) AS n, count(*) FILTER (q >= 15) AS x, count(*) FILTER (q >= 29) AS nm, count(*) FILTER (q >= 36) AS rp, count(*) FILTER (q >= 43) AS rv, arg_max(st, q) AS top FROM ex GROUP BY ALL),
k AS (SELECT state, count(*) AS n FROM lo GROUP BY ALL),
l AS (SELECT state, count(DISTINCT id) AS u, count(*) AS n FROM ca JOIN lo USING (id) GROUP BY ALL),
m AS (SELECT de.state, n_nationkey % 2 = 0 AS night, expected, coalesce(k.n, 0) AS en, coalesce(u, 0) AS u, coalesce(l.n, 0) AS ln, coalesce(e2.n, 0) AS er,
        coalesce(x, 0) AS x, coalesce(nm, 0) AS nm, coalesce(rp, 0) AS rp, coalesce(rv, 0) AS rv, coalesce(top, 'discovered') AS top
      FROM de LEFT JOIN k USING (state) LEFT JOIN l USING (state) LEFT JOIN e2 USING (state))
SELECT state, expected, en AS enumerated, u AS with_lead, ln AS lead_rows, round(en / nullif(expected, 0), 6) AS enumeration_ratio, er AS execution_rows,
  x AS executable, nm AS normalized, rp AS replay_tested, rv AS refresh_verified, top AS highest_stage,
  CAST(3 * night::INT + 2 * (expected > 0 AND en < expected)::INT + 2 * (en > 0 AND u < en)::INT + 2 * (nm = 0)::INT AS BIGINT) AS depth_priority,
  coalesce(nullif(concat_ws(';', CASE WHEN expected > 0 AND en < expected THEN 'enumeration_gap' END, CASE WHEN en > 0 AND u < en THEN 'source_lead_gap' END,
    CASE WHEN er = 0 THEN 'no_execution_evidence' END, CASE WHEN nm = 0 THEN 'no_normalized_execution' END,
    CASE WHEN night AND rv = 0 THEN 'election_night_refresh_unverified' END), ''), 'baseline_satisfied') AS depth_reasons FROM m
""")
def depth_matrix(spark, sf_dir):
    lo, de, ca = _base(spark, sf_dir)
    leads = ca.join(lo.select("jurisdiction_id", "state"), "jurisdiction_id")
    ex = _execution(spark, sf_dir)
    s = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey")).alias("state"),
        F.concat(F.lit("n"), F.col("s_nationkey")).alias("nation"))
    ex = ex.join(s, "state").select(F.col("nation").alias("state"),
                                    F.col("execution_stage").alias("stage"))
    night = F.substring("state", 2, 9).cast("int") % 2 == 0
    surfaces = de.select("state", night.cast("string").alias("election_night_candidate"))
    out = V.depth_matrix(surfaces, de, lo, leads, ex)
    return out.drop("lead_ratio").withColumn("enumeration_ratio", F.round("enumeration_ratio", 6))


@query("blended_score", """
WITH s AS (SELECT s_nationkey AS source, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS pop, count(DISTINCT l_partkey) AS units
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
n AS (SELECT sum(CAST(l_quantity AS BIGINT)) AS p, count(DISTINCT l_partkey) AS u FROM lineitem)
SELECT source, round(pop / p, 9) AS population_gain, round(units / u, 9) AS unit_gain, round(0.5 * (pop / p) + 0.5 * (units / u), 9) AS score_50,
  round(0.4 * (pop / p) + 0.6 * (units / u), 9) AS score_40, round(0.6 * (pop / p) + 0.4 * (units / u), 9) AS score_60 FROM s, n
""")
def blended_score(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey",
                                                 F.col("l_quantity").cast("long").alias("q"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    per = li.join(s, li.l_suppkey == s.s_suppkey).groupBy(F.col("s_nationkey").alias("source")).agg(
        F.sum("q").alias("pop"), F.count_distinct("l_partkey").alias("units"))
    total = li.agg(F.sum("q").alias("_p"), F.count_distinct("l_partkey").alias("_u"))
    # One row: the national totals.
    out = V.blended_score(per.join(F.broadcast(total)), "pop", "units", F.col("_p"), F.col("_u"))
    return out.select("source", *[F.round(c, 9).alias(c) for c in (
        "population_gain", "unit_gain", "score_50", "score_40", "score_60")])


@query("visibility_proxy", """
WITH p AS (SELECT c_nationkey AS nation, CAST(floor(sum(abs(c_acctbal)) / 3) AS BIGINT) AS pop FROM (SELECT c_nationkey, floor(c_acctbal) AS c_acctbal FROM customer) GROUP BY ALL),
t AS (SELECT *, greatest(1, CAST(round_even(2 * pow(pop / 10000.0, 0.55), 0) AS BIGINT)) AS ty, 0.35 + 0.20 * greatest(0.0, log10(pop / 10000.0)) AS s FROM p)
SELECT nation, pop, greatest(1, CAST(round_even(cbrt(pop) / 10, 0) AS BIGINT)) AS proxy, ty AS typical,
  greatest(1, CAST(round_even(ty * exp(-1.645 * s), 0) AS BIGINT)) AS lower, greatest(ty, CAST(round_even(ty * exp(1.645 * s), 0) AS BIGINT)) AS upper FROM t
""")
def visibility_proxy(spark, sf_dir):
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.floor(F.sum(F.abs(F.floor("c_acctbal"))) / 3).alias("pop"))
    band = c.withColumn("b", V.visibility_band(F.col("pop")))
    return band.select("nation", "pop", V.visibility_proxy(F.col("pop")).alias("proxy"), "b.*")


@query("covered_population", """
WITH s AS (SELECT o_custkey AS place, max(CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 END) AS best FROM orders GROUP BY ALL),
c AS (SELECT c_custkey AS place, CAST(floor(abs(c_acctbal)) AS BIGINT) AS p FROM customer)
SELECT CAST(sum(p) FILTER (best >= 1) AS BIGINT) AS "any", CAST(sum(p) FILTER (best >= 2) AS BIGINT) AS municipality_or_finer, CAST(sum(p) FILTER (best >= 3) AS BIGINT) AS precinct_or_finer,
  CAST(coalesce(sum(p) FILTER (s.place IS NOT NULL AND best IS NULL), 0) AS BIGINT) AS unknown_resolution, CAST(sum(p) AS BIGINT) AS total FROM c LEFT JOIN s USING (place)
""")
def covered_population(spark, sf_dir):
    places = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("place"), F.floor(F.abs("c_acctbal")).alias("population"))
    p = F.col("o_orderpriority")
    sources = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("place"),
        F.when(p == "1-URGENT", 3).when(p == "2-HIGH", 2).when(p == "3-MEDIUM", 1)
        .alias("resolution"))
    return V.covered_population(places, sources)


@query("assurance_packet", """
SELECT l_suppkey AS unit, count(*) FILTER (l_returnflag = 'N') AS passed, count(*) FILTER (l_returnflag = 'R' AND l_quantity > 49) AS material_unresolved_discrepancies,
  coalesce(string_agg(DISTINCT CASE WHEN l_returnflag = 'A' THEN 'check' || CAST(l_linenumber AS VARCHAR) END, '|' ORDER BY CASE WHEN l_returnflag = 'A' THEN 'check' || CAST(l_linenumber AS VARCHAR) END), '') AS underpowered,
  CASE WHEN count(*) FILTER (l_returnflag = 'R' AND l_quantity > 49) > 0 THEN 'material_discrepancy' WHEN count(*) FILTER (l_returnflag = 'N') > 0
    THEN 'consistent_with_observed_evidence' ELSE 'insufficient_evidence' END AS status FROM lineitem GROUP BY ALL
""")
def assurance_packet(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("unit"),
        F.concat(F.lit("check"), F.col("l_linenumber")).alias("check"),
        F.when(F.col("l_returnflag") == "N", "pass")
        .when(F.col("l_returnflag") == "A", "underpowered")
        .when(F.col("l_quantity") > 49, "fail").otherwise("skipped").alias("status"))
    return V.assurance_packet(rows, ["unit"]).select(
        "unit", "passed", "material_unresolved_discrepancies",
        F.array_join("underpowered_checks", "|").alias("underpowered"), "status")


@query("swing_residuals", """
WITH v AS (SELECT l_suppkey AS u, s_nationkey AS nation, n_regionkey AS region, sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS a,
             sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS b FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
SELECT u AS unit, CAST(b - a AS BIGINT) AS swing, round((b - a) - avg(b - a) OVER (), 4) AS residual_national,
  round((b - a) - avg(b - a) OVER (PARTITION BY region), 4) AS residual_region, round((b - a) - avg(b - a) OVER (PARTITION BY nation), 4) AS residual_nation FROM v
""")
def swing_residuals(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("unit")).agg(
        F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("long")).otherwise(0))
        .alias("a"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("long")).otherwise(0))
        .alias("b"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("region"))
    units = li.join(s, li.unit == s.s_suppkey).join(n, s.nation == n.n_nationkey)
    out = V.swing_residuals(units, "a", "b", ["region", "nation"])
    return out.select("unit", "swing", *[F.round(c, 4).alias(c) for c in (
        "residual_national", "residual_region", "residual_nation")])


_CAT_SQL = f"""
{CP_SQL},
ta AS (SELECT page_id, url AS page, link, CASE l_returnflag WHEN 'A' THEN 15 WHEN 'N' THEN 10 ELSE 0 END AS w, max((l_linestatus = 'O')::INT) AS kw FROM cpl GROUP BY ALL),
tb AS (SELECT page_id, page, link, w, kw, CASE WHEN w > 0 AND kw = 1 THEN 'result_artifact_lead' WHEN kw = 1 THEN 'results_page_lead' END AS kind FROM ta
  UNION ALL SELECT page_id, url, url, 0, 1, 'results_page_lead' FROM (SELECT page_id, url, bool_or(l_linestatus = 'O' OR o_orderstatus = 'F') AS k FROM cpl GROUP BY ALL) WHERE k)
"""


def _catalog(spark, sf_dir):
    return K.catalog_rows(L.discover(captured_pages(spark, sf_dir).drop("o_orderdate", "state")))


@query("source_catalog", f"""
WITH {_CAT_SQL}
SELECT 'discovered:' || substr(sha256(link), 1, 16) AS source_id, link AS url, max(w + 20 * kw) AS score,
  CASE WHEN count(*) FILTER (kind = 'result_artifact_lead') > 0 THEN 'result_artifact_lead' ELSE 'results_page_lead' END AS catalog_kind,
  count(*) AS observed_from_pages, CASE WHEN bool_or(page = link) THEN 'fetched' ELSE 'not_fetched' END AS target_status
FROM tb WHERE kind IS NOT NULL GROUP BY ALL
""")
def source_catalog(spark, sf_dir):
    pages = captured_pages(spark, sf_dir)
    status = pages.select("url", F.lit("fetched").alias("status"),
                          F.sha2("html", 256).alias("sha256"))
    out = K.build_catalog(_catalog(spark, sf_dir), status)
    return out.select("source_id", "url", "score", "catalog_kind", "observed_from_pages",
                      "target_status")


@query("catalog_summary", f"""
WITH {_CAT_SQL},
c AS (SELECT link, CASE WHEN count(*) FILTER (kind = 'result_artifact_lead') > 0 THEN 'result_artifact_lead' ELSE 'results_page_lead' END AS k,
        CASE WHEN bool_or(page = link) THEN 'fetched' ELSE 'not_fetched' END AS s FROM tb WHERE kind IS NOT NULL GROUP BY ALL)
SELECT k AS catalog_kind, s AS target_status, count(*) AS cataloged_urls, count(DISTINCT link) AS publisher_keys FROM c GROUP BY ALL
""")
def catalog_summary(spark, sf_dir):
    pages = captured_pages(spark, sf_dir)
    status = pages.select("url", F.lit("fetched").alias("status"), F.lit("").alias("sha256"))
    return K.catalog_summary(K.build_catalog(_catalog(spark, sf_dir), status))


@query("catalog_evidence", f"""
WITH {_CAT_SQL},
e AS (SELECT link, tb.page, cpl.label FROM tb JOIN cpl USING (page_id, link) WHERE kind IS NOT NULL AND (l_linestatus = 'O' OR w > 0))
SELECT DISTINCT link AS url, 'observed_from' AS attribute, page AS value FROM tb WHERE kind IS NOT NULL
UNION SELECT DISTINCT link, 'election_label', label FROM e
UNION SELECT link, 'observed_year', unnest([y FOR y IN string_split_regex(link || ' ' || label, '[^0-9]+') IF regexp_full_match(y, '(19|20)[0-9]{{2}}')]) FROM e
UNION SELECT link, 'observed_year', unnest([y FOR y IN string_split_regex(link, '[^0-9]+') IF regexp_full_match(y, '(19|20)[0-9]{{2}}')]) FROM tb WHERE kind IS NOT NULL
""")
def catalog_evidence(spark, sf_dir):
    return K.catalog_evidence(_catalog(spark, sf_dir))


@query("candidate_associations", f"""
WITH {_CAT_SQL}
SELECT DISTINCT link AS candidate_url, page AS seed_url, page_id % 3 AS jurisdiction_id,
  CASE WHEN link = page THEN 'fetched_unverified' ELSE 'candidate' END AS verification_status FROM tb WHERE kind IS NOT NULL
""")
def candidate_associations(spark, sf_dir):
    pages = captured_pages(spark, sf_dir)
    seeds = pages.select("url", (F.col("page_id") % 3).alias("jurisdiction_id"))
    state = pages.select("url", F.lit("fetched_unverified").alias("verification_status"))
    return K.candidate_associations(_catalog(spark, sf_dir), seeds, state)


@query("priority_queues", f"""
SELECT 'depth' AS queue, CAST(state AS VARCHAR) AS state, depth_priority AS priority, row_number() OVER (ORDER BY depth_priority DESC, state) AS queue_position FROM ({ORACLES["depth_matrix"]})
UNION ALL SELECT 'gap', CAST(state AS VARCHAR), gap_priority, row_number() OVER (ORDER BY gap_priority DESC, state) FROM ({ORACLES["corpus_gaps"]})
""")
def priority_queues(spark, sf_dir):
    parts = []
    for name, source, priority in (("depth", "depth_matrix", "depth_priority"),
                                   ("gap", "corpus_gaps", "gap_priority")):
        queue = priority_queue(QUERIES[source](spark, sf_dir), priority)
        parts.append(queue.select(F.lit(name).alias("queue"), F.col("state").cast("string"),
                                  F.col(priority).alias("priority"), "queue_position"))
    return parts[0].unionByName(parts[1])
