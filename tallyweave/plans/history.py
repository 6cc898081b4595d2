"""Queries over intervals and ordered histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.operators import history, identity, intervals as iv, observations as obs
from tallyweave.operators.sliced import running_before
from tallyweave.plans.registry import query
from tallyweave.plans.views import I_SQL, P_SQL, intervals, progress, table


@query("alias_as_of", f"""
WITH {I_SQL},
probes AS (SELECT DISTINCT 'customer-' || CAST(o_custkey AS VARCHAR) AS alias,
             CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 30 END AS w
           FROM orders),
m AS (SELECT p.alias, p.w, count(DISTINCT canonical_id) AS n, min(canonical_id) AS canonical_id
      FROM probes p JOIN i ON i.alias = p.alias AND i.status = 'verified'
       AND ((p.w IS NULL AND effective_from IS NULL AND effective_to IS NULL)
         OR (p.w IS NOT NULL AND coalesce(effective_from, DATE '0001-01-01') <= p.w
             AND p.w <= coalesce(effective_to, DATE '9999-12-31')))
      GROUP BY ALL)
SELECT probes.alias, CAST(probes.w AS VARCHAR) AS as_of,
       CASE WHEN m.n = 1 THEN m.canonical_id END AS canonical_id
FROM probes LEFT JOIN m ON m.alias = probes.alias AND m.w IS NOT DISTINCT FROM probes.w
""")
def alias_as_of(spark, sf_dir):
    aliases = intervals(spark, sf_dir)
    when = F.when(F.col("o_orderkey") % 4 != 0, F.date_add(F.to_date("o_orderdate"), 30))
    probes = table(spark, sf_dir, "orders").select(
        F.lit("jurisdiction").alias("object_type"),
        F.lit("orders").alias("alias_namespace"),
        F.concat(F.lit("customer "), F.col("o_custkey")).alias("alias_value"),
        when.alias("when")).distinct()
    out = identity.resolve_aliases(probes, aliases)
    return out.select(F.replace("alias_value", F.lit(" "), F.lit("-")).alias("alias"),
                      F.col("when").cast("string").alias("as_of"), "canonical_id")


@query("interval_overlaps", f"""
WITH {I_SQL},
v AS (SELECT alias, canonical_id, coalesce(effective_from, DATE '0001-01-01') AS s,
             coalesce(effective_to, DATE '9999-12-31') AS e, decision_id
      FROM i WHERE status = 'verified'),
r AS (SELECT *, max(e) OVER (PARTITION BY alias, canonical_id ORDER BY s, decision_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END)
             OVER (PARTITION BY alias, canonical_id ORDER BY s, decision_id) AS grp FROM r),
m AS (SELECT alias, canonical_id, min(s) AS s, max(e) AS e FROM g
      GROUP BY alias, canonical_id, grp),
pairs AS (SELECT a.alias, a.canonical_id, a.s, a.e, b.e AS oe, b.canonical_id AS oid,
            row_number() OVER (PARTITION BY a.alias, a.canonical_id, a.s
                               ORDER BY b.e DESC, b.canonical_id DESC) AS rn
          FROM m a JOIN m b ON a.alias = b.alias AND a.canonical_id <> b.canonical_id
           AND (b.s < a.s OR (b.s = a.s AND (b.e, b.canonical_id) < (a.e, a.canonical_id)))
           AND b.e >= a.s)
SELECT alias, canonical_id, CAST(s AS VARCHAR) AS starts, CAST(e AS VARCHAR) AS ends,
       oid AS other_canonical_id, CAST(oe AS VARCHAR) AS other_ends
FROM pairs WHERE rn = 1
""")
def interval_overlaps(spark, sf_dir):
    out = identity.alias_collisions(intervals(spark, sf_dir))
    return out.select("alias", "canonical_id", F.col("starts").cast("string"),
                      F.col("ends").cast("string"), "other_canonical_id",
                      F.col("other_ends").cast("string"))


@query("adjacent_overlaps", f"""
WITH {I_SQL},
v AS (SELECT alias, decision_id, coalesce(effective_from, DATE '0001-01-01') AS s,
             coalesce(effective_to, DATE '9999-12-31') AS e FROM i),
l AS (SELECT *, lag(e) OVER (PARTITION BY alias ORDER BY s, decision_id) AS p FROM v)
SELECT alias, decision_id, CAST(p AS VARCHAR) AS previous_to FROM l WHERE s <= p
""")
def adjacent_overlaps(spark, sf_dir):
    rows = identity.with_lookup_key(intervals(spark, sf_dir))
    out = iv.adjacent_overlaps(rows, ["_alias"], "effective_from", "effective_to", "decision_id")
    return out.select(F.col("_alias").alias("alias"), "decision_id",
                      F.col("previous_to").cast("string"))


@query("alias_downgrades", f"""
WITH {I_SQL}
SELECT DISTINCT a.alias, a.canonical_id, a.status FROM i a
WHERE a.status <> 'verified' AND EXISTS (SELECT 1 FROM i b
  WHERE b.alias = a.alias AND b.status = 'verified'
    AND coalesce(b.effective_from, DATE '0001-01-01') <= coalesce(a.effective_to, DATE '9999-12-31')
    AND coalesce(b.effective_to, DATE '9999-12-31') >= coalesce(a.effective_from, DATE '0001-01-01'))
""")
def alias_downgrades(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    _, bad = identity.merge_aliases(rows.filter("status = 'verified'"),
                                    rows.filter("status <> 'verified'"))
    return bad.select(F.col("_alias").alias("alias"), "canonical_id", "status").distinct()


@query("alias_merge", """
WITH k AS (SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus = 'P' AS candidate,
             CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders)
SELECT candidate, count(*) AS decisions FROM k GROUP BY ALL
""")
def alias_merge(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    merged, _ = identity.merge_aliases(rows.filter("decision_id % 3 <> 0"),
                                       rows.filter("decision_id % 3 < 2"))
    return merged.groupBy((F.col("status") == "candidate").alias("candidate")).agg(
        F.count(F.lit(1)).alias("decisions"))


@query("external_alias", """
SELECT 'supplier:' || CAST(l_suppkey AS VARCHAR) || ':' || CAST(l_orderkey AS VARCHAR) AS canonical_id,
       'parts' AS alias_namespace, 'Part ' || CAST(min(l_partkey) AS VARCHAR) AS alias_value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'
GROUP BY l_suppkey, l_orderkey HAVING count(DISTINCT l_partkey) = 1
""")
def external_alias(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey",
                                                 "l_linenumber")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    aliases = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.concat_ws(":", F.lit("supplier"), "l_suppkey", "l_orderkey").alias("canonical_id"),
        F.lit("external_id").alias("alias_kind"), F.lit("Parts").alias("alias_namespace"),
        F.concat(F.lit("Part "), F.col("l_partkey")).alias("alias_value"),
        F.when(F.col("o_orderstatus") == "F", "verified").otherwise("candidate").alias("status"),
        F.col("l_linenumber").alias("seq"))
    return identity.external_alias(aliases, "seq", namespace="parts")


@query("exclusive_geography", """
WITH g AS (SELECT c_custkey AS u, o_orderpriority AS geo, o_orderkey,
             CASE WHEN o_orderkey % 8 = 0 THEN 'synthetic' WHEN o_orderkey % 2 = 0 THEN 'exact'
                  ELSE 'contains' END AS t,
             CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 20 AS e
           FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT DISTINCT 'unit:' || CAST(a.u AS VARCHAR) AS reporting_unit_id,
       'non_geographic_with_geography' AS rule_id
FROM g a JOIN g b ON a.u = b.u AND a.t = 'synthetic' AND b.t <> 'synthetic'
 AND a.s <= b.e AND b.s <= a.e
UNION ALL
SELECT DISTINCT 'unit:' || CAST(a.u AS VARCHAR), 'exact_to_several_geographies'
FROM g a JOIN g b ON a.u = b.u AND a.t = 'exact' AND b.t = 'exact' AND a.geo < b.geo
 AND a.s <= b.e AND b.s <= a.e
""")
def exclusive_geography(spark, sf_dir):
    day = F.to_date("o_orderdate")
    kind = (F.when(F.col("o_orderkey") % 8 == 0, "synthetic_non_geographic")
            .when(F.col("o_orderkey") % 2 == 0, "exact").otherwise("contains"))
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("unit:"), F.col("o_custkey")).alias("reporting_unit_id"),
        F.col("o_orderpriority").alias("geographic_unit_id"), kind.alias("relationship_type"),
        day.alias("effective_from"), F.date_add(day, 20).alias("effective_to"))
    return identity.exclusive_geography_violations(rows)


@query("allocation_weight_audit", """
WITH n AS (SELECT s_nationkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS t
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
s AS (SELECT s_nationkey, s_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
w AS (SELECT s_nationkey, count(*) AS rows, count(*) FILTER (s_suppkey % 11 <> 0) AS weighted,
             sum(CASE WHEN s_suppkey % 11 <> 0 THEN CAST(q AS DOUBLE) / t END) AS total
      FROM s JOIN n USING (s_nationkey) GROUP BY ALL)
SELECT 'nation:' || CAST(s_nationkey AS VARCHAR) AS reporting_unit_id,
       CASE WHEN weighted <> rows THEN 'mixed_weighted_and_unweighted'
            ELSE 'partial_without_residual' END AS finding
FROM w WHERE weighted > 0 AND (weighted <> rows OR s_nationkey % 2 = 1)
""")
def allocation_weight_audit(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("q"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    shares = li.join(s, li.l_suppkey == s.s_suppkey)
    totals = shares.groupBy("s_nationkey").agg(F.sum("q").alias("t"))
    rows = shares.join(totals, "s_nationkey").select(
        F.concat(F.lit("nation:"), F.col("s_nationkey")).alias("reporting_unit_id"),
        F.lit("split_across").alias("relationship_type"),
        F.lit(None).cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.when(F.col("s_suppkey") % 11 != 0, F.col("q") / F.col("t")).alias("allocation_weight"),
        F.lit("votes").alias("weight_basis"),
        F.when(F.col("s_nationkey") % 2 == 0, "complete").otherwise("partial")
        .alias("allocation_coverage"),
        F.lit(None).cast("double").alias("unmapped_weight"),
        F.lit(None).cast("string").alias("unmapped_basis"))
    return identity.allocation_weight_findings(rows).select("reporting_unit_id", "finding")


@query("progress_audit", f"""
WITH {P_SQL},
w AS (SELECT *,
  last_value(CASE WHEN kind = 'source_counts' THEN reporting_count END IGNORE NULLS) OVER win AS pr,
  last_value(CASE WHEN kind = 'source_counts' THEN expected_count END IGNORE NULLS) OVER win AS pe,
  last_value(CASE WHEN kind = 'source_complete' THEN complete END IGNORE NULLS) OVER win AS pc
  FROM p WINDOW win AS (PARTITION BY jurisdiction_id, source_id ORDER BY ts, seq
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT jurisdiction_id, source_id, seq, 'cumulative_count_decreased' AS finding, pr AS before,
       reporting_count AS after FROM w WHERE kind = 'source_counts' AND reporting_count < pr
UNION ALL SELECT jurisdiction_id, source_id, seq, 'reporting_exceeds_expected', expected_count,
       reporting_count FROM w WHERE kind = 'source_counts' AND reporting_count > expected_count
UNION ALL SELECT jurisdiction_id, source_id, seq, 'expected_count_changed', pe, expected_count
       FROM w WHERE kind = 'source_counts' AND expected_count <> pe
UNION ALL SELECT jurisdiction_id, source_id, seq, 'completion_regressed', 1, 0
       FROM w WHERE kind = 'source_complete' AND pc AND NOT complete
""")
def progress_audit(spark, sf_dir):
    out = history.progress_findings(progress(spark, sf_dir), tie="seq")
    return out.select("jurisdiction_id", "source_id", "seq", "finding", "before", "after")


def _source_checks(spark, sf_dir):
    """Events as checks of a source per user; an error is a failed check."""
    ok = F.col("event_type") != "error"
    return table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.unix_micros("ts").alias("at"), ok.alias("verified"),
        F.when(~ok, F.concat(F.lit("error:"), F.get_json_object("props", "$.k")))
        .otherwise("").alias("failure_class"),
        F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("verification_ledger", """
WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS tm, event_type <> 'error' AS ok,
           'error:' || json_extract_string(props, '$.k') AS fc FROM events)
SELECT user_id, bool_or(ok) AS ever_verified, min(tm) FILTER (ok) AS first_verified_at,
       max(tm) FILTER (ok) AS last_verified_at, max(tm) AS last_checked_at,
       arg_max(ok, (tm, event_id)) AS currently_reachable,
       arg_max(CASE WHEN ok THEN '' ELSE fc END, (tm, event_id)) AS last_failure_class
FROM e GROUP BY user_id
""")
def verification_ledger(spark, sf_dir):
    return history.fold_ledger(_source_checks(spark, sf_dir), ["user_id"], "at", "event_id").drop(
        "last_arrival")


@query("out_of_order_checks", """
WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS tm,
             CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000000000 + event_id AS arrival
           FROM events),
w AS (SELECT *, max(tm) OVER (PARTITION BY user_id ORDER BY arrival
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM e)
SELECT user_id, event_id, coalesce(tm < latest, false) AS refused FROM w
""")
def out_of_order_checks(spark, sf_dir):
    rows = _source_checks(spark, sf_dir).withColumn(
        "arrival", F.col("k") * 1_000_000_000 + F.col("event_id"))
    out = history.out_of_order(rows, ["user_id"], "at", "arrival")
    return out.select("user_id", "event_id", "refused")


_CAPTURES = """
c AS (SELECT o_custkey AS page, epoch_us(o_orderdate) + o_orderkey AS tm, o_orderpriority AS dg,
             o_orderstatus AS rd, o_orderkey FROM orders),
l AS (SELECT DISTINCT page, tm, l_suppkey % 20 AS link FROM c JOIN lineitem ON l_orderkey = o_orderkey),
t AS (SELECT *, lag(tm) OVER w AS pt, lead(tm) OVER w AS nt, lag(dg) OVER w AS pd, lag(rd) OVER w AS pr
      FROM c WINDOW w AS (PARTITION BY page ORDER BY tm)),
s AS (SELECT l.page, l.tm, l.link, pt, nt, lag(l.tm) OVER w AS sb, lead(l.tm) OVER w AS sn
      FROM l JOIN t USING (page, tm) WINDOW w AS (PARTITION BY l.page, l.link ORDER BY l.tm))
"""


@query("page_events", f"""
WITH {_CAPTURES}
SELECT page, tm AS observed_at, CASE WHEN pt IS NULL THEN 'baseline_captured' WHEN pd <> dg THEN 'page_changed'
       ELSE 'fingerprints_reclassified' END AS kind, CAST(page AS VARCHAR) AS link
FROM t WHERE pt IS NULL OR pd <> dg OR pr <> rd
UNION ALL
SELECT page, tm, CASE WHEN sb IS NULL THEN 'candidate_discovered' ELSE 'candidate_reappeared' END,
       CAST(link AS VARCHAR) FROM s WHERE sb IS NULL OR sb < pt
UNION ALL
SELECT page, nt, 'link_not_observed_this_capture', CAST(link AS VARCHAR) FROM s
WHERE nt IS NOT NULL AND (sn IS NULL OR sn > nt)
""")
def page_events(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    micros = F.unix_micros("o_orderdate") + F.col("o_orderkey")
    captures = o.select(
        F.col("o_custkey").alias("page"), F.timestamp_micros(micros).alias("at"),
        F.col("o_orderpriority").alias("digest"), F.col("o_orderstatus").alias("rules_digest"),
        "o_orderkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    links = captures.join(li, captures.o_orderkey == li.l_orderkey).select(
        "page", "at", (F.col("l_suppkey") % 20).alias("link"))
    out = history.page_events(captures, links, "page", "at")
    return out.select("page", F.unix_micros("at").alias("observed_at"), "kind", "link")


@query("feed_status", """
WITH e AS (SELECT user_id, event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS tm,
       CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'host_deferred' ELSE 'ok' END AS st
       FROM events),
ls AS (SELECT user_id, max((tm, event_id)) FILTER (st = 'ok') AS k, max(tm) FILTER (st = 'ok') AS last_success,
              max(tm) AS last_attempt, arg_max(st, (tm, event_id)) AS status, count(*) AS attempts
       FROM e GROUP BY ALL),
f AS (SELECT e.user_id, count(*) FILTER (st = 'failed' AND (k IS NULL OR (tm, event_id) > k)) AS failures
      FROM e JOIN ls USING (user_id) GROUP BY ALL)
SELECT user_id, last_success, last_attempt, status, attempts, failures,
       last_success IS NULL OR 1706659200 - last_success > 86400 AS stale,
       last_attempt + CASE WHEN status = 'failed'
         THEN least(3600, 60 * CAST(pow(2, least(greatest(failures, 1) - 1, 6)) AS BIGINT))
         ELSE 60 END AS next_due
FROM ls JOIN f USING (user_id)
""")
def feed_status(spark, sf_dir):
    kind = (F.when(F.col("event_type") == "error", "failed")
            .when(F.col("event_type") == "signup", "host_deferred").otherwise("ok"))
    attempts = table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.unix_seconds("ts").alias("at"), kind.alias("status"))
    return history.feed_status(
        attempts, ["user_id"], "at", "event_id", now=F.lit(1706659200).cast("long"),
        stale_after=F.lit(86400), interval=F.lit(60).cast("long"))


@query("queue_lateness", """
WITH u AS (SELECT c_custkey, max(CAST(epoch(o_orderdate) AS BIGINT)) AS nxt
           FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY ALL)
SELECT count(*) FILTER (coalesce(nxt, 0) <= 980000000) AS remaining_due_pages,
       count(*) FILTER (nxt IS NULL) AS unvisited_pages,
       coalesce(max(greatest(0, 980000000 - nxt)), 0) AS oldest_due_lateness_seconds FROM u
""")
def queue_lateness(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    o = (table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").groupBy("o_custkey")
         .agg(F.max(F.unix_seconds("o_orderdate")).alias("next_check_at")))
    pages = c.join(o, c.c_custkey == o.o_custkey, "left")
    return history.lateness(pages, F.lit(980000000).cast("long"))


@query("refresh_evidence", """
WITH s AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS cfg,
             lag(o_orderkey) OVER w AS pk, lag(CAST(o_orderdate AS DATE)) OVER w AS pd,
             lag(o_orderstatus) OVER w AS pcfg
           FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
q AS (SELECT l_orderkey, l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS v
      FROM lineitem GROUP BY ALL),
c AS (SELECT s.o_orderkey, s.d, s.pd, s.cfg, s.pcfg,
        count(*) FILTER (o.v IS NOT NULL AND n.v IS NOT NULL) AS common_rows,
        count(*) FILTER (o.v <> n.v) AS changed_rows,
        count(*) FILTER (o.v IS NOT NULL AND n.v IS NULL) AS removed_rows,
        count(*) FILTER (n.v < o.v) AS decreased_rows
      FROM s CROSS JOIN (VALUES ('A'), ('N'), ('R')) f(rf)
        LEFT JOIN q o ON o.l_orderkey = s.pk AND o.l_returnflag = f.rf
        LEFT JOIN q n ON n.l_orderkey = s.o_orderkey AND n.l_returnflag = f.rf
      WHERE s.pk IS NOT NULL GROUP BY ALL)
SELECT o_orderkey AS new_sample,
  CASE WHEN cfg <> pcfg THEN 'different_configuration' WHEN pd >= d THEN 'times_not_increasing'
       WHEN pd - DATE '1998-06-02' NOT BETWEEN -1 AND 7 OR d - DATE '1998-06-02' NOT BETWEEN -1 AND 7
         THEN 'outside_reporting_window'
       WHEN common_rows = 0 OR changed_rows = 0 OR removed_rows > 0 THEN 'no_continuous_change'
       WHEN decreased_rows > 0 THEN 'cumulative_decrease' END AS refusal
FROM c
""")
def refresh_evidence(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                              "o_orderstatus")
    before = F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("d"),
                      F.col("o_orderstatus").alias("c"))
    samples = running_before(o, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                             {"_old": ("last", before)})
    samples = samples.filter("_old is not null")
    votes = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("votes"))
    new = samples.join(votes, samples.o_orderkey == votes.l_orderkey).select(
        F.col("o_orderkey").alias("new_sample"), "l_returnflag", "votes")
    old = samples.join(votes, F.col("_old.k") == votes.l_orderkey).select(
        F.col("o_orderkey").alias("new_sample"), "l_returnflag", "votes")
    counts = obs.change_summary(old, new, cumulative=True, keys=["l_returnflag"],
                                scope=["new_sample"])
    meta = samples.select(
        F.col("o_orderkey").alias("new_sample"), F.col("_old.d").alias("old_at"),
        F.col("o_orderdate").alias("new_at"), F.lit(0).alias("old_warnings"),
        F.lit(0).alias("new_warnings"),
        (F.col("_old.c") == F.col("o_orderstatus")).alias("same_config"))
    day = F.lit("1998-06-02").cast("date")
    pairs = meta.join(counts, "new_sample", "left").fillna(0)
    return history.refresh_evidence(pairs, day).select(
        "new_sample", "refusal")


@query("mode_release_order", """
WITH f AS (SELECT s_nationkey, l_linestatus || l_returnflag AS vote_mode, min(l_shipdate) AS f
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
SELECT s_nationkey, vote_mode, rank() OVER (PARTITION BY s_nationkey ORDER BY f) AS release_order,
       CAST(epoch(f) - epoch(min(f) OVER (PARTITION BY s_nationkey)) AS BIGINT) AS lag_seconds
FROM f
""")
def mode_release_order(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.concat("l_linestatus", "l_returnflag").alias("vote_mode"), "l_shipdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    rows = li.join(s, li.l_suppkey == s.s_suppkey)
    out = history.mode_release_order(rows, ["s_nationkey"], "l_shipdate")
    return out.withColumn("release_order", F.col("release_order").cast("long"))
