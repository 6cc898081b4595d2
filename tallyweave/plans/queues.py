"""Queries over similarity, hierarchies, frontiers and work queues."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.operators import frontier as Q, graph as G, overlap as M
from tallyweave.functions import classify as C
from tallyweave.operators import links as L
from tallyweave.operators import ordered as R
from tallyweave.plans.registry import query
from tallyweave.plans.views import CP_SQL, O_SQL, captured_pages, observations, table

_V_SQL = """
v AS (SELECT 'label:' || CAST(label AS VARCHAR) AS jurisdiction_id, vec_id % 2 AS side, vec_id AS cap,
        ((vec_id * 37) % 97) / 97.0::DOUBLE AS f, CAST(embedding AS DOUBLE[]) AS e,
        list_distinct(['u' || CAST(vec_id % 7 AS VARCHAR), 'u' || CAST(vec_id % 3 AS VARCHAR)]) AS u,
        CASE WHEN vec_id % 4 < 2 THEN [] ELSE ['m' || CAST(vec_id % 3 AS VARCHAR)] END AS m
      FROM embeddings),
r AS (SELECT jurisdiction_id, f, min(cap) AS cap FROM v WHERE side = 1 GROUP BY ALL),
j AS (SELECT l.jurisdiction_id, l.cap AS left_at, r.cap AS right_at, abs(l.f - r.f) AS d, l.e AS le, l.u AS lu, l.m AS lm,
        row_number() OVER (PARTITION BY l.cap ORDER BY abs(l.f - r.f), r.cap) AS rn
      FROM v l JOIN r ON l.jurisdiction_id = r.jurisdiction_id AND l.side = 0 AND abs(l.f - r.f) <= 0.05),
k AS (SELECT j.jurisdiction_id, left_at, right_at, d, list_cosine_similarity(le, v.e) AS sim,
        len(list_intersect(lu, v.u))::DOUBLE / nullif(len(list_distinct(list_concat(lu, v.u))), 0) AS uj,
        len(list_intersect(lm, v.m))::DOUBLE / nullif(len(list_distinct(list_concat(lm, v.m))), 0) AS mj
      FROM j JOIN v ON v.cap = j.right_at WHERE rn = 1)
"""


def _snapshots(spark, sf_dir):
    v = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("label:"), F.col("label")).alias("jurisdiction_id"),
        (v % 2).alias("side"), v.alias("captured_at"),
        ((v * 37 % 97) / F.lit(97.0)).alias("reporting_fraction"),
        F.col("embedding").cast("array<double>").alias("result_vector"),
        F.array_distinct(F.array(F.concat(F.lit("u"), v % 7), F.concat(F.lit("u"), v % 3)))
        .alias("reporting_units"),
        F.when(v % 4 < 2, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("m"), v % 3))).alias("vote_modes"))


def _matches(spark, sf_dir):
    s = _snapshots(spark, sf_dir)
    return M.match_snapshots(s.filter("side = 0"), s.filter("side = 1"))


@query("snapshot_matches", f"""
WITH {_V_SQL}
SELECT jurisdiction_id, left_at, right_at, round(d, 9) AS progress_distance, round(sim, 6) AS vector_similarity,
       round(uj, 6) AS unit_jaccard, round(mj, 6) AS mode_jaccard FROM k
""")
def snapshot_matches(spark, sf_dir):
    return _matches(spark, sf_dir).select(
        "jurisdiction_id", "left_at", "right_at",
        F.round("progress_distance", 9).alias("progress_distance"),
        F.round("vector_similarity", 6).alias("vector_similarity"),
        F.round("reporting_unit_jaccard", 6).alias("unit_jaccard"),
        F.round("vote_mode_jaccard", 6).alias("mode_jaccard"))


@query("mirror_pairs", f"""
WITH {_V_SQL}
SELECT jurisdiction_id, count(*) AS matched_snapshots, round(avg(sim), 5) AS mean_similarity,
       CASE WHEN avg(sim) >= 0.995 AND coalesce(avg(uj), 1) >= 0.9 THEN 'probable_mirror'
            WHEN avg(uj) > 0 OR avg(mj) > 0 THEN 'partial_overlap' ELSE 'uncertain' END AS relationship,
       false AS independent FROM k GROUP BY ALL
""")
def mirror_pairs(spark, sf_dir):
    out = M.summarize_overlap(_matches(spark, sf_dir), ["jurisdiction_id"])
    return out.select("jurisdiction_id", "matched_snapshots",
                      F.round("mean_similarity", 5).alias("mean_similarity"), "relationship",
                      F.col("residual_independence_established").alias("independent"))


@query("hierarchy_rollup", f"""
WITH {O_SQL}
SELECT 'source_id' AS level, source_id AS key, CAST(sum(votes) AS BIGINT) AS votes FROM o GROUP BY ALL
UNION ALL SELECT 'jurisdiction_id', jurisdiction_id, CAST(sum(votes) AS BIGINT) FROM o GROUP BY ALL
UNION ALL SELECT 'reporting_unit_id', reporting_unit_id, CAST(sum(votes) AS BIGINT) FROM o GROUP BY ALL
""")
def hierarchy_rollup(spark, sf_dir):
    return G.rollup_paths(observations(spark, sf_dir),
                          ["source_id", "jurisdiction_id", "reporting_unit_id"], "votes")


_NEXT_SQL = """
nx AS (SELECT c, arg_min(nxt, k) AS p FROM (SELECT o_custkey AS c, o_orderkey AS k,
         lead(o_custkey) OVER (PARTITION BY o_orderkey // 50 ORDER BY o_orderkey) AS nxt FROM orders)
       WHERE nxt IS NOT NULL GROUP BY ALL)
"""


def _next_customer(spark, sf_dir):
    """Each customer points at the customer of the order after its first, within blocks of 50."""
    from pyspark.sql import Window
    block = F.floor(F.col("o_orderkey") / 50)
    w = Window.partitionBy(block).orderBy("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    nxt = o.withColumn("nxt", F.lead("o_custkey").over(w)).filter("nxt is not null")
    return nxt.groupBy(F.col("o_custkey").alias("c")).agg(
        F.min_by("nxt", "o_orderkey").alias("p"))


@query("hierarchy_cycles", f"""
WITH RECURSIVE {_NEXT_SQL},
walk(s, n) AS (SELECT c, p FROM nx UNION SELECT s, p FROM walk JOIN nx ON n = c)
SELECT DISTINCT s AS node FROM walk WHERE s = n
""")
def hierarchy_cycles(spark, sf_dir):
    return G.pointer_cycles(_next_customer(spark, sf_dir), "c", "p").select(
        F.col("c").alias("node"))


@query("edge_cycles", f"""
WITH RECURSIVE {_NEXT_SQL},
walk(s, n) AS (SELECT c, p FROM nx UNION SELECT s, p FROM walk JOIN nx ON n = c)
SELECT DISTINCT s AS child_id, p AS parent_id FROM walk JOIN nx ON s = c WHERE s = n
""")
def edge_cycles(spark, sf_dir):
    edges = _next_customer(spark, sf_dir).select(
        F.col("c").alias("child_id"), F.col("p").alias("parent_id"))
    return G.edge_cycles(edges)


@query("hierarchy_violations", """
WITH u AS (SELECT 's' || CAST(s_suppkey AS VARCHAR) AS id, s_nationkey % 7 AS e, s_nationkey AS j,
             's' || CAST(s_suppkey * 3 % 130 AS VARCHAR) AS p FROM supplier),
x AS (SELECT * FROM u UNION ALL SELECT * FROM u WHERE j = 3)
SELECT id AS reporting_unit_id, 'duplicate_unit_id' AS rule_id FROM x GROUP BY ALL HAVING count(*) > 1
UNION ALL
SELECT x.id, CASE WHEN q.id IS NULL THEN 'unknown_parent' WHEN q.e <> x.e THEN 'parent_in_other_regime'
       ELSE 'parent_in_other_jurisdiction' END
FROM x LEFT JOIN u q ON x.p = q.id WHERE q.id IS NULL OR q.e <> x.e OR q.j <> x.j
""")
def hierarchy_violations(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    units = s.select(
        F.concat(F.lit("s"), key).alias("reporting_unit_id"),
        (F.col("s_nationkey") % 7).cast("string").alias("election_id"),
        F.lit("r").alias("reporting_regime_id"),
        F.col("s_nationkey").cast("string").alias("jurisdiction_id"),
        F.concat(F.lit("s"), key * 3 % 130).alias("parent_reporting_unit_id"))
    return G.hierarchy_violations(units.unionByName(units.filter("jurisdiction_id = '3'")))


@query("children", """
SELECT DISTINCT 'p' || CAST(l_partkey AS VARCHAR) AS child_id FROM lineitem WHERE l_suppkey = 7 AND l_returnflag = 'A'
""")
def children(spark, sf_dir):
    edges = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey")).alias("parent_id"),
        F.concat(F.lit("p"), F.col("l_partkey")).alias("child_id"),
        F.when(F.col("l_returnflag") == "A", "contains").otherwise("overlaps").alias("relation"))
    return G.children(edges, "s7", "contains").distinct()


@query("follow_links", """
WITH e AS (SELECT DISTINCT 's' || CAST(l_suppkey AS VARCHAR) AS a, 'p' || CAST(l_partkey AS VARCHAR) AS b
           FROM lineitem WHERE l_returnflag = 'A'),
b AS (SELECT DISTINCT 'p' || CAST(l_partkey AS VARCHAR) AS a, 's' || CAST(l_suppkey AS VARCHAR) AS b
      FROM lineitem WHERE l_returnflag <> 'A'),
h AS (SELECT * FROM e UNION SELECT * FROM b),
s AS (SELECT 's' || CAST(s_suppkey AS VARCHAR) AS url, s_nationkey AS unit FROM supplier),
d1 AS (SELECT DISTINCT h.b AS url, unit FROM s JOIN h ON url = a),
d2 AS (SELECT DISTINCT h.b AS url, unit FROM d1 JOIN h ON url = a),
x AS (SELECT url, unit, 0 AS depth FROM s UNION ALL SELECT url, unit, 1 FROM d1 UNION ALL SELECT url, unit, 2 FROM d2)
SELECT url, unit, min(depth) AS depth FROM x GROUP BY ALL
""")
def follow_links(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    s = F.concat(F.lit("s"), F.col("l_suppkey"))
    p = F.concat(F.lit("p"), F.col("l_partkey"))
    hops = li.filter("l_returnflag = 'A'").select(s.alias("url"), p.alias("target")).unionByName(
        li.filter("l_returnflag <> 'A'").select(p.alias("url"), s.alias("target")))
    seeds = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey")).alias("url"), F.col("s_nationkey").alias("unit"))
    return G.follow(seeds, hops, 2)


_FRONTIER_SQL = """
ev AS (SELECT user_id AS u, 'state' || CAST(user_id % 11 AS VARCHAR) AS st, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS t,
         event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
un AS (SELECT DISTINCT u, st FROM ev),
g AS (SELECT u, max(f) AS growth, count(*) AS urls FROM (SELECT u, k % 10 AS url, min(t) AS f FROM ev
        WHERE event_type = 'signup' GROUP BY ALL) GROUP BY ALL),
rd AS (SELECT u, t - t % 21600 AS t, bool_or(event_type = 'purchase') AS found, bool_and(event_type IN ('view', 'click')) AS quiet
       FROM ev WHERE event_type <> 'signup' GROUP BY ALL),
la AS (SELECT u, max(t) AS last FROM rd GROUP BY ALL),
lr AS (SELECT rd.*, coalesce(growth, 0) AS growth FROM rd LEFT JOIN g USING (u)),
x AS (SELECT u, max(t) FILTER (found) AS r FROM lr WHERE t > growth GROUP BY ALL),
q AS (SELECT lr.u, count(*) FILTER (quiet AND (r IS NULL OR t > r)) AS n FROM lr JOIN x USING (u) WHERE t > growth GROUP BY ALL),
fr AS (SELECT un.u, st, coalesce(n, 0) AS quiet_rounds, coalesce(last, 0) AS last, coalesce(growth, 0) AS growth,
         coalesce(urls, 0) AS urls,
         CASE WHEN coalesce(growth, 0) > coalesce(last, 0) OR coalesce(last, 0) = 0 THEN 0
              ELSE last + CASE WHEN coalesce(n, 0) >= 3 THEN 86400 ELSE 21600 END END AS due
       FROM un LEFT JOIN g USING (u) LEFT JOIN la USING (u) LEFT JOIN q USING (u))
"""


def _frontier(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    unit = F.col("user_id").alias("jurisdiction_id")
    at = F.unix_seconds("ts")
    units = ev.select(unit, F.concat(F.lit("state"), F.col("user_id") % 11).alias("state")).distinct()
    k = F.get_json_object("props", "$.k").cast("long")
    evidence = ev.filter("event_type = 'signup'").select(
        unit, (k % 10).alias("url"), at.alias("observed_at"))
    outcome = (F.when(F.col("event_type") == "purchase", Q.FOUND)
               .when(F.col("event_type").isin("view", "click"), Q.QUIET).otherwise("blocked"))
    attempts = ev.filter("event_type <> 'signup'").select(
        unit, (at - at % 21600).alias("attempted_at"), outcome.alias("outcome"))
    return Q.discovery_frontier(units, evidence, attempts, F.lit(1706600000).cast("long"))


@query("quiet_rounds", f"""
WITH {_FRONTIER_SQL}
SELECT u AS jurisdiction_id, st AS state, quiet_rounds AS completed_quiet_rounds,
  CASE WHEN quiet_rounds >= 3 THEN 'exhausted_for_now' ELSE 'active' END AS discovery_status,
  urls AS observed_candidate_urls, last AS last_attempt_at, growth AS last_new_evidence_at,
  due AS next_search_at, 1706600000 >= due AS search_due FROM fr
""")
def quiet_rounds(spark, sf_dir):
    return _frontier(spark, sf_dir)


@query("search_queue", f"""
WITH {_FRONTIER_SQL},
d AS (SELECT u, st, row_number() OVER (PARTITION BY st ORDER BY last, u) AS turn FROM fr WHERE 1706600000 >= due),
s AS (SELECT st, max(last) AS latest FROM fr GROUP BY ALL)
SELECT u AS jurisdiction_id, st AS state, turn FROM d JOIN s USING (st) ORDER BY turn, latest, st LIMIT 20
""")
def search_queue(spark, sf_dir):
    return Q.search_queue(_frontier(spark, sf_dir)).select(
        "jurisdiction_id", "state", F.col("turn").cast("long"))


@query("due_pages", """
WITH p AS (SELECT c_custkey, c_nationkey, c_name, max(CAST(epoch(o_orderdate) AS BIGINT)) AS lc
           FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL),
d AS (SELECT c_name AS url, c_nationkey AS state, coalesce(lc, 0) AS lc, row_number() OVER (
        PARTITION BY c_nationkey ORDER BY coalesce(lc, 0), c_name) AS turn
      FROM p WHERE coalesce(lc + 86400 * 10, 0) <= 990000000)
SELECT url, state, turn FROM d ORDER BY turn, lc, state LIMIT 100
""")
def due_pages(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.max(F.unix_seconds("o_orderdate")).alias("last_checked_at"))
    pages = c.join(o, c.c_custkey == o.o_custkey, "left").select(
        F.col("c_name").alias("url"), F.col("c_nationkey").alias("state"), "last_checked_at",
        (F.col("last_checked_at") + 864000).alias("next_check_at"))
    out = Q.due_pages(pages, F.lit(990000000), 100)
    return out.select("url", "state", F.col("turn").cast("long"))


@query("seed_order", """
SELECT c_name AS url, c_nationkey AS state, turn FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey
  ORDER BY c_acctbal < 0, c_name) AS turn FROM customer) ORDER BY turn, c_nationkey LIMIT 200
""")
def seed_order(spark, sf_dir):
    seeds = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("url"), F.col("c_nationkey").alias("state"),
        (F.col("c_acctbal") < 0).alias("is_fallback"))
    return Q.seed_order(seeds, 200).select("url", "state", F.col("turn").cast("long"))


@query("best_artifact", f"""
WITH {CP_SQL},
s AS (SELECT DISTINCT page_id, link, CASE l_returnflag WHEN 'A' THEN 'csv' ELSE 'unknown' END AS kind,
        CASE l_returnflag WHEN 'A' THEN 35 ELSE 0 END AS score FROM cpl),
r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, link) AS rn FROM s WHERE score > 0)
SELECT page_id, link, kind, score FROM r WHERE rn = 1
""")
def best_artifact(spark, sf_dir):
    rows = L.anchors(captured_pages(spark, sf_dir).select("page_id", "url", "html"))
    rows = rows.select("page_id", F.regexp_replace("link", r"\?.*$", "").alias("link")).filter(
        "link is not null").distinct()
    scored = rows.withColumn("kind", C.artifact_kind(F.col("link"))).withColumn(
        "score", C.artifact_score(F.col("link"))).filter("score > 0")
    best = Q.top_per_group(scored, ["page_id"], [F.col("score").desc(), F.col("link")], 1)
    return best.select("page_id", "link", "kind", "score")


@query("top3_per_group", """
SELECT l_suppkey AS unit, l_orderkey, l_linenumber, rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey
  ORDER BY l_quantity DESC, l_orderkey DESC, l_linenumber) AS rank FROM lineitem) WHERE rank <= 3
""")
def top3_per_group(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("unit"), "l_quantity", "l_orderkey", "l_linenumber")
    out = Q.top_per_group(li, ["unit"], [F.col("l_quantity").desc(), F.col("l_orderkey").desc(),
                                         F.col("l_linenumber")], 3)
    return out.select("unit", "l_orderkey", "l_linenumber", F.col("rank").cast("long"))


@query("candidate_caps", """
WITH r AS (SELECT l_suppkey, count(*) AS candidates FROM lineitem GROUP BY ALL)
SELECT l_suppkey AS page, candidates, least(candidates, 200) AS kept, candidates > 200 AS truncated FROM r
""")
def candidate_caps(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("page"), "l_orderkey",
                                                 "l_linenumber")
    kept, over = Q.capped(li, ["page"], [F.col("l_orderkey"), F.col("l_linenumber")], 200)
    n = kept.groupBy("page").agg(F.count(F.lit(1)).alias("kept"))
    out = n.join(over, "page", "left")
    return out.select("page", F.coalesce("candidates", "kept").alias("candidates"), "kept",
                      F.col("candidates").isNotNull().alias("truncated"))


@query("cap_at_expected", """
WITH r AS (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer),
e AS (SELECT s_nationkey, count(*) * 3 AS n FROM supplier GROUP BY ALL)
SELECT c_custkey, c_nationkey AS state FROM r JOIN e ON s_nationkey = c_nationkey WHERE rn <= n
""")
def cap_at_expected(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("state"))
    expected = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("state")).agg(
        (F.count(F.lit(1)) * 3).alias("expected_primary_units"))
    return Q.cap_at_expected(rows, expected, "state", "c_custkey").select("c_custkey", "state")


# Registries over the given tables: customers are units, nations are states.
_REG_SQL = """
lo AS (SELECT c_custkey AS id, c_nationkey AS state FROM customer),
di AS (SELECT DISTINCT o_custkey AS id, c_nationkey AS state, CASE o_orderstatus WHEN 'F' THEN 'final' ELSE 'live' END AS role,
         'https://u' || CAST(o_custkey % 900 AS VARCHAR) || '.example.org/' || substr(o_orderpriority, 1, 1) AS url
       FROM orders JOIN customer ON o_custkey = c_custkey AND o_orderkey % 9 = 0),
ce AS (SELECT DISTINCT s_nationkey + CASE WHEN s_nationkey % 5 = 0 THEN 100 ELSE 0 END AS state, 'https://dir.example.org/' || CAST(s_suppkey % 4 AS VARCHAR) AS url FROM supplier),
c2 AS (SELECT state, url, row_number() OVER (PARTITION BY state ORDER BY url) AS rn FROM ce),
st AS (SELECT id, state, role, url FROM di UNION ALL
       SELECT lo.id, lo.state, 'state_directory_fallback', c2.url FROM lo JOIN c2 ON lo.state = c2.state AND rn <= 2
       WHERE lo.id NOT IN (SELECT id FROM di)),
ob AS (SELECT DISTINCT 'https://u' || CAST(l_partkey % 900 AS VARCHAR) || '.example.org/' || CAST(l_linenumber AS VARCHAR) AS parent,
         'https://r.example.org/' || CAST(l_suppkey AS VARCHAR) AS url, l_linestatus AS ls FROM lineitem)
"""


def _registries(spark, sf_dir):
    lo = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("jurisdiction_id"),
                                                 F.col("c_nationkey").alias("state"))
    # Eight of nine direct pages name a unit, and a fifth of the directories a state, that no list has.
    unlisted = F.when(F.col("o_orderkey") % 9 > 0, 1_000_000_000).otherwise(0)
    o = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + unlisted).alias("jurisdiction_id"), "o_orderstatus",
        "o_orderpriority")
    direct = o.join(lo, "jurisdiction_id").select(
        "jurisdiction_id", "state",
        F.when(F.col("o_orderstatus") == "F", "final").otherwise("live").alias("page_role"),
        F.concat(F.lit("https://u"), F.col("jurisdiction_id") % 900, F.lit(".example.org/"),
                 F.left("o_orderpriority", F.lit(1))).alias("url"))
    central = table(spark, sf_dir, "supplier").select(
        (F.col("s_nationkey") + F.when(F.col("s_nationkey") % 5 == 0, 100).otherwise(0)).alias("state"),
        F.concat(F.lit("https://dir.example.org/"), F.col("s_suppkey") % 4).alias("url"))
    li = table(spark, sf_dir, "lineitem")
    observed = li.select(
        F.concat(F.lit("https://u"), F.col("l_partkey") % 900, F.lit(".example.org/"),
                 F.col("l_linenumber")).alias("parent"),
        F.concat(F.lit("https://r.example.org/"), F.col("l_suppkey")).alias("url"),
        "l_linestatus").distinct()
    return lo, direct, central, observed


@query("start_pages", f"WITH {_REG_SQL} SELECT id AS jurisdiction_id, state, role AS page_role, url FROM st")
def start_pages(spark, sf_dir):
    lo, direct, central, _ = _registries(spark, sf_dir)
    return Q.start_pages(direct, lo, central)


@query("start_gaps", f"""
WITH {_REG_SQL}
SELECT lo.id AS jurisdiction_id, lo.state, CASE WHEN EXISTS (SELECT 1 FROM st WHERE st.id = lo.id)
  THEN 'state_fallback_only' ELSE 'no_starting_url' END AS gap FROM lo WHERE lo.id NOT IN (SELECT id FROM di)
""")
def start_gaps(spark, sf_dir):
    lo, direct, central, _ = _registries(spark, sf_dir)
    return Q.start_gaps(Q.start_pages(direct, lo, central), lo)


@query("unit_actions", f"""
WITH {_REG_SQL},
ch AS (SELECT parent, count(DISTINCT url) AS n FROM ob GROUP BY ALL),
a AS (SELECT id, count(DISTINCT CASE WHEN role <> 'state_directory_fallback' THEN url END) AS d,
        count(DISTINCT CASE WHEN role = 'state_directory_fallback' THEN url END) AS f,
        CAST(coalesce(sum(CASE WHEN role <> 'state_directory_fallback' THEN n END), 0) AS BIGINT) AS o
      FROM st LEFT JOIN ch ON parent = url GROUP BY ALL)
SELECT lo.id AS jurisdiction_id, state, coalesce(d, 0) AS direct_starts, coalesce(f, 0) AS fallback_starts,
  coalesce(o, 0) AS observed_leads, CASE WHEN o > 0 THEN 'inspect_observed_result_leads' WHEN d > 0 THEN 'extract_links_from_local_start'
    WHEN f > 0 THEN 'resolve_local_authority_from_state_directory' ELSE 'find_official_starting_page' END AS next_action
FROM lo LEFT JOIN a USING (id)
""")
def unit_actions(spark, sf_dir):
    lo, direct, central, observed = _registries(spark, sf_dir)
    return Q.unit_actions(lo, Q.start_pages(direct, lo, central), observed)


@query("unit_buckets", f"""
WITH {_REG_SQL},
cl AS (SELECT DISTINCT c_custkey AS id, 'https://r.example.org/' || CAST(c_custkey % 400 AS VARCHAR) AS url FROM customer WHERE c_acctbal > 5000),
hu AS (SELECT id, url FROM di UNION SELECT id, url FROM cl),
ky AS (SELECT url AS h, ls = 'F' AS f FROM ob UNION ALL SELECT parent, ls = 'F' FROM ob),
k2 AS (SELECT h, bool_or(f) AS f FROM ky GROUP BY ALL),
b AS (SELECT id, bool_or(coalesce(f, false)) AS o FROM hu LEFT JOIN k2 ON h = url GROUP BY ALL)
SELECT lo.id AS jurisdiction_id, state, CASE WHEN o THEN 'observed_result_page_candidate' WHEN o IS NOT NULL
  THEN 'evidence_backed_hunting_location' ELSE 'unresolved_location' END AS bucket FROM lo LEFT JOIN b USING (id)
""")
def unit_buckets(spark, sf_dir):
    lo, direct, central, observed = _registries(spark, sf_dir)
    clues = table(spark, sf_dir, "customer").filter("c_acctbal > 5000").select(
        F.col("c_custkey").alias("jurisdiction_id"),
        F.concat(F.lit("https://r.example.org/"), F.col("c_custkey") % 400).alias("url"))
    catalog = observed.select(
        "url", "parent", F.lit("results_page_lead").alias("catalog_kind"),
        F.when(F.col("l_linestatus") == "F", "fetched").otherwise("not_fetched")
        .alias("target_status"))
    return Q.unit_buckets(lo, Q.start_pages(direct, lo, central), clues, catalog)


@query("known_leads", """
SELECT o_orderkey, EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey + o_orderkey % 2 * 100000
  AND c_nationkey = o_custkey % 25) AS accepted FROM orders
""")
def known_leads(spark, sf_dir):
    lo = _registries(spark, sf_dir)[0]
    leads = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_custkey") + F.col("o_orderkey") % 2 * 100000)
        .alias("jurisdiction_id"), (F.col("o_custkey") % 25).cast("int").alias("state"))
    good, bad = Q.known_leads(leads, lo)
    return good.select("o_orderkey", F.lit(True).alias("accepted")).unionByName(
        bad.select("o_orderkey", F.lit(False).alias("accepted")))


@query("seed_associations", r"""
SELECT DISTINCT regexp_replace(regexp_replace(url, '#.*$', ''), '\?utm_source=feed$', '') AS seed_url,
  regexp_extract(html, 'lang="([a-z]*)"', 1) AS lang FROM pages WHERE NOT regexp_matches(url, '[?&]ref=')
""")
def seed_associations(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "url", F.regexp_extract("html", 'lang="([a-z]*)"', 1).alias("lang"))
    return Q.seed_associations(pages, "url", ["lang"])


@query("union_seeds", """
WITH a AS (SELECT CAST(c_custkey % 700 AS VARCHAR) AS j, 'https://a.example.org/' || CAST(c_nationkey AS VARCHAR) AS url, 'unit' AS lv, c_nationkey AS s, 0 AS f FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'https://a.example.org/' || CAST(s_nationkey AS VARCHAR), 'source', s_nationkey, 1 FROM supplier)
SELECT j AS jurisdiction_id, url, arg_max(lv, f) AS jurisdiction_level, max(s) AS state FROM a GROUP BY ALL
""")
def union_seeds(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 700).cast("string").alias("jurisdiction_id"), F.col("c_nationkey").alias("state"),
        F.lit("unit").alias("jurisdiction_level"),
        F.concat(F.lit(" https://a.example.org/"), F.col("c_nationkey"), F.lit("#x")).alias("url"))
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("jurisdiction_id"),
        F.col("s_nationkey").alias("state"), F.lit("source").alias("jurisdiction_level"),
        F.concat(F.lit("https://a.example.org/"), F.col("s_nationkey")).alias("url"))
    mail = c.withColumn("url", F.lit("mailto:a@example.org"))
    return Q.union_seeds([c, mail, s])


@query("keep_first_leads", """
SELECT o_custkey, o_orderpriority, min(o_orderkey) AS first_key, arg_min(o_orderstatus, o_orderkey) AS first_status,
       max(o_orderkey) AS last_key FROM orders GROUP BY ALL
""")
def keep_first_leads(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderkey",
                                              "o_orderstatus")
    keys = ["o_custkey", "o_orderpriority"]
    first = Q.keep_first(o, keys, "o_orderkey").withColumnsRenamed(
        {"o_orderkey": "first_key", "o_orderstatus": "first_status"})
    last = Q.keep_last(o, keys, "o_orderkey").select(*keys, F.col("o_orderkey").alias("last_key"))
    return first.join(last, keys)


@query("directory_seeds", f"""
WITH {CP_SQL},
n2 AS (SELECT n_nationkey, 'S' || CAST(n_regionkey AS VARCHAR) AS st FROM nation)
SELECT DISTINCT link AS url, state, 'us:nation:' || CAST(s_nationkey AS VARCHAR) AS unit, cpl.url AS observed_from
FROM cpl JOIN n2 ON n_nationkey = s_nationkey AND st = state WHERE title <> 'Access Denied' AND l_returnflag = 'R'
""")
def directory_seeds(spark, sf_dir):
    from tallyweave.plans.web import _nation_units
    pages = captured_pages(spark, sf_dir).select("url", "state", "html")
    links = L.directory_links(pages, _nation_units(spark, sf_dir))
    out = Q.directory_seeds(links.withColumn("seq", F.col("label")), "seq")
    return out.select("url", "state", "unit", "observed_from")


@query("monitoring_seeds", f"""
WITH {_FRONTIER_SQL},
sd AS (SELECT u, 'https://p.example.org/' || CAST(k AS VARCHAR) AS url, min(k % 2) AS depth FROM ev GROUP BY ALL),
cd AS (SELECT u, 'https://p.example.org/' || CAST(k AS VARCHAR) AS url, count(*) AS score FROM ev WHERE event_type = 'view' GROUP BY ALL),
b AS (SELECT u, url FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, url DESC) AS rn FROM cd) WHERE rn <= 3),
pg AS (SELECT 'https://p.example.org/' || CAST(k AS VARCHAR) AS url, max(t) AS ls FROM ev WHERE event_type = 'click' GROUP BY ALL),
xx AS (SELECT sd.url, bool_and(quiet_rounds >= 3) AS parked, max(depth) AS depth, bool_or(b.url IS NOT NULL) AS best
      FROM sd JOIN fr USING (u) LEFT JOIN b ON b.u = sd.u AND b.url = sd.url GROUP BY ALL)
SELECT xx.url, parked FROM xx LEFT JOIN pg USING (url)
WHERE NOT (parked AND ((depth > 0 AND NOT best) OR (ls IS NOT NULL AND 1706600000 < ls + 86400)))
""")
def monitoring_seeds(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    rows = ev.select(F.col("user_id").alias("unit"), k.alias("k"), "event_type",
                     F.concat(F.lit("https://p.example.org/"), k).alias("url"),
                     F.unix_seconds("ts").alias("t"))
    seeds = rows.groupBy("unit", "url").agg(F.min(F.col("k") % 2).alias("watch_depth"))
    cands = rows.filter("event_type = 'view'").groupBy("unit", "url").agg(
        F.count(F.lit(1)).alias("score"))
    pages = rows.filter("event_type = 'click'").groupBy("url").agg(
        F.max("t").alias("last_success_at"))
    return Q.monitoring_seeds(seeds, cands, _frontier(spark, sf_dir), pages,
                              F.lit(1706600000).cast("long"))


@query("frontier_export", f"""
WITH {_FRONTIER_SQL},
d AS (SELECT u, st, row_number() OVER (PARTITION BY st ORDER BY last, u) AS turn FROM fr WHERE 1706600000 >= due),
s AS (SELECT st, max(last) AS latest FROM fr GROUP BY ALL),
t AS (SELECT u, row_number() OVER (ORDER BY turn, latest, st) AS queue_turn FROM d JOIN s USING (st))
SELECT u AS jurisdiction_id, st AS state, row_number() OVER (ORDER BY st, u) AS position, CASE WHEN queue_turn <= 20 THEN queue_turn END AS queue_turn
FROM fr LEFT JOIN t USING (u)
""")
def frontier_export(spark, sf_dir):
    return R.frontier_export(_frontier(spark, sf_dir)).select(
        "jurisdiction_id", "state", "position", "queue_turn")


@query("harvested_sources", r"""
WITH c AS (SELECT 0 AS o, 'first' AS origin, l_orderkey AS r, l_suppkey AS k, l_partkey AS p FROM lineitem WHERE l_returnflag = 'A'
  UNION ALL SELECT 1, 'second', l_orderkey, l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'N'
  UNION ALL SELECT 2, 'third', l_orderkey, l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'R'),
u AS (SELECT *, 'S' || CAST(k % 9 AS VARCHAR) AS state, CASE p % 8 WHEN 0 THEN 'https://a.clarityelections.com/' WHEN 1 THEN 'https://x.example.org/Results/Public/' WHEN 2 THEN 'https://enr.example.org/'
    WHEN 3 THEN 'https://x.example.org/a.CSV?' WHEN 4 THEN 'https://x.example.org/b.xlsx?' WHEN 5 THEN 'http://x.example.gov/c.pdf?' WHEN 6 THEN 'https://x.co.us/' ELSE 'ftp://x.example.org/' END
    || CAST(p % 40 AS VARCHAR) AS url FROM c),
f AS (SELECT state, url, arg_min(origin, (o, r)) AS source_origin, any_value(p % 8) AS m FROM u WHERE p % 8 < 7 GROUP BY ALL)
SELECT state, url AS source_url, source_origin, CASE WHEN m = 0 THEN 'clarity' WHEN m < 3 THEN 'results_portal' WHEN m < 5 THEN 'tabular_export' WHEN m = 5 THEN 'document' ELSE 'official_web' END AS platform_family,
  CASE m WHEN 0 THEN 'clarity' WHEN 3 THEN 'wide_csv' WHEN 4 THEN 'wide_sheet' WHEN 5 THEN 'document_text' ELSE '' END AS parser_family,
  CASE WHEN m IN (0, 3, 4, 5) THEN 'adapter_candidate' ELSE 'needs_family_probe' END AS execution_stage FROM f
""")
def harvested_sources(spark, sf_dir):
    heads = ["https://a.clarityelections.com/", "https://x.example.org/Results/Public/",
             "https://enr.example.org/", "https://x.example.org/a.CSV?", "https://x.example.org/b.xlsx?",
             "http://x.example.gov/c.pdf?", "https://x.co.us/", "ftp://x.example.org/"]
    p = F.col("l_partkey")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_orderkey", F.concat(F.lit("S"), F.col("l_suppkey") % 9).alias("state"),
        F.concat(F.lit(" "), F.element_at(F.array(*[F.lit(h) for h in heads]),
                                          (p % 8 + 1).cast("int")), p % 40).alias("url"))
    out = Q.harvested_sources([
        (origin, rows.filter(F.col("l_returnflag") == flag), "url", "l_orderkey")
        for origin, flag in (("first", "A"), ("second", "N"), ("third", "R"))])
    return out.select("state", "source_url", "source_origin", "platform_family", "parser_family",
                      "execution_stage")
