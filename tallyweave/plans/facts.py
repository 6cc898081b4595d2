"""Queries over the fact view: reconciliation, diffs, guards and digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.operators import modes, observations as obs
from tallyweave.plans.registry import query
from tallyweave.plans.views import O_SQL, observations, table, with_totals


def reconcile_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: unit detail, short of every seventh unit, against nation totals."""
    o = observations(spark, sf_dir)
    number = F.split("reporting_unit_id", ":")[1].cast("long")
    guard = obs.double_count_violations(o)
    detail = o.filter(number % 7 != 0)
    out = obs.reconcile_to_summary(detail, o, scope=["jurisdiction_id"])
    flagged = guard.select("jurisdiction_id").distinct()
    return out.join(flagged, "jurisdiction_id", "left_anti")


query("reconcile_units_to_summary", f"""
WITH {O_SQL},
s AS (SELECT jurisdiction_id, contest_name, choice_name, vote_mode,
             CAST(sum(votes) AS BIGINT) AS summary_total FROM o GROUP BY ALL),
d AS (SELECT jurisdiction_id, contest_name, choice_name, vote_mode,
             CAST(sum(votes) AS BIGINT) AS precinct_sum
      FROM o WHERE CAST(split_part(reporting_unit_id, ':', 2) AS BIGINT) % 7 <> 0 GROUP BY ALL)
SELECT s.*, coalesce(precinct_sum, 0) AS precinct_sum,
       coalesce(precinct_sum, 0) - summary_total AS residual,
       coalesce(precinct_sum, 0) = summary_total AS reconciles
FROM s LEFT JOIN d USING (jurisdiction_id, contest_name, choice_name, vote_mode)
""")(reconcile_units)


@query("double_count_violations", f"""
WITH {O_SQL}
SELECT election_id, jurisdiction_id, source_id, CAST(NULL AS VARCHAR) AS capture,
       reporting_unit_id, contest_name AS contest, choice_name AS choice
FROM o WHERE CAST(split_part(reporting_unit_id, ':', 2) AS BIGINT) % 3 = 0 GROUP BY ALL
""")
def double_count(spark, sf_dir):
    return obs.double_count_violations(with_totals(observations(spark, sf_dir)))


@query("aggregate_observations", f"""
WITH {O_SQL}
SELECT election_id, contest_name, choice_name, vote_mode, CAST(sum(votes) AS BIGINT) AS votes
FROM o GROUP BY ALL
""")
def aggregate(spark, sf_dir):
    return obs.aggregate_observations(observations(spark, sf_dir), scope=["election_id"])


def _by_year(spark, sf_dir):
    """Each year's observations beside those of the year before, both labelled by the later."""
    o = observations(spark, sf_dir)
    year = F.col("election_id").cast("int")
    current = o.withColumn("year", year)
    previous = o.withColumn("year", year + 1)
    span = o.agg(F.min(year).alias("lo"), F.max(year).alias("hi"))
    current = current.join(F.broadcast(span), year > F.col("lo")).drop("lo", "hi")
    previous = previous.join(F.broadcast(span), F.col("year") <= F.col("hi")).drop("lo", "hi")
    return previous, current


_YEARS = f"""
WITH {O_SQL},
span AS (SELECT min(CAST(election_id AS INT)) lo, max(CAST(election_id AS INT)) hi FROM o),
cur AS (SELECT CAST(election_id AS INT) AS year, * FROM o, span WHERE CAST(election_id AS INT) > lo),
prev AS (SELECT CAST(election_id AS INT) + 1 AS year, * FROM o, span
         WHERE CAST(election_id AS INT) < hi)
"""


@query("snapshot_diff", _YEARS + """
SELECT c.year, c.reporting_unit_id, c.contest_name, c.choice_name, c.vote_mode,
       p.votes AS old_votes, c.votes AS new_votes, c.votes - coalesce(p.votes, 0) AS delta
FROM cur c LEFT JOIN prev p USING (year, reporting_unit_id, contest_name, choice_name, vote_mode)
WHERE p.votes IS DISTINCT FROM c.votes
""")
def diff(spark, sf_dir):
    previous, current = _by_year(spark, sf_dir)
    return obs.snapshot_diff(previous, current, keys=["year", *obs.DIFF_KEY])


@query("change_summary", _YEARS + """
SELECT coalesce(c.year, p.year) AS year, count(*) FILTER (p.votes IS NULL) AS added_rows,
       count(*) FILTER (c.votes IS NULL) AS removed_rows,
       count(*) FILTER (p.votes <> c.votes) AS changed_rows,
       count(*) FILTER (c.votes < p.votes) AS decreased_rows,
       count(*) FILTER (c.votes IS NOT NULL AND p.votes IS NOT NULL) AS common_rows
FROM cur c FULL JOIN prev p
  ON c.year = p.year AND c.reporting_unit_id = p.reporting_unit_id
 AND c.contest_name = p.contest_name AND c.choice_name = p.choice_name
 AND c.vote_mode = p.vote_mode
GROUP BY ALL
""")
def changes(spark, sf_dir):
    previous, current = _by_year(spark, sf_dir)
    blank = F.lit(None).cast("string")
    add = {"party": blank, "raw_vote_mode": blank}
    return obs.change_summary(previous.withColumns(add), current.withColumns(add),
                              cumulative=True, scope=["year"])


@query("capture_review", _YEARS + """
, s AS (
SELECT coalesce(c.year, p.year) AS year, coalesce(c.source_id, p.source_id) AS source_id,
       count(*) FILTER (c.votes IS NULL) AS removed_rows,
       count(*) FILTER (c.votes < p.votes) AS decreased_rows
FROM cur c FULL JOIN prev p
  ON c.year = p.year AND c.source_id = p.source_id AND c.reporting_unit_id = p.reporting_unit_id
 AND c.contest_name = p.contest_name AND c.choice_name = p.choice_name
 AND c.vote_mode = p.vote_mode
GROUP BY ALL)
SELECT year, source_id,
       concat_ws('|', CASE WHEN removed_rows > 0 THEN 'rows_disappeared' END,
                 CASE WHEN decreased_rows > 0 THEN 'cumulative_votes_decreased' END) AS warnings,
       CASE WHEN removed_rows > 0 OR decreased_rows > 0 THEN 'review_required' ELSE 'ok' END
         AS status
FROM s
""")
def review(spark, sf_dir):
    previous, current = _by_year(spark, sf_dir)
    summary = obs.change_summary(previous, current, cumulative=True, keys=obs.DIFF_KEY,
                                 scope=["year", "source_id"])
    out = obs.capture_warnings(summary)
    return out.select("year", "source_id", F.array_join("warnings", "|").alias("warnings"),
                      "status")


@query("duplicate_observations", """
SELECT l_suppkey, o_orderpriority, l_returnflag, l_linestatus, year(o_orderdate) AS election,
       count(*) AS copies
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL HAVING count(*) > 1
""")
def duplicates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag",
                                                 "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority",
                                              F.year("o_orderdate").cast("long")
                                              .alias("election"))
    joined = li.join(o, li.l_orderkey == o.o_orderkey)
    return obs.duplicate_keys(
        joined, ["l_suppkey", "o_orderpriority", "l_returnflag", "l_linestatus", "election"])


@query("table_digest", f"""
WITH {O_SQL},
h AS (SELECT election_id, sha256(concat_ws(chr(10),
        'choice_name=''' || choice_name || '''', 'contest_name=''' || contest_name || '''',
        'jurisdiction_id=''' || jurisdiction_id || '''',
        'reporting_unit_id=''' || reporting_unit_id || '''',
        'vote_mode=''' || vote_mode || '''', 'votes=''' || CAST(votes AS VARCHAR) || '''')) AS h
      FROM o)
SELECT election_id, count(*) AS row_count, sha256(concat_ws('|', CAST(count(*) AS VARCHAR),
  {", ".join(f"CAST(sum(CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT)) AS VARCHAR)"
             for i in range(8))})) AS digest
FROM h GROUP BY election_id
""")
def digest(spark, sf_dir):
    cols = ["choice_name", "contest_name", "jurisdiction_id", "reporting_unit_id", "vote_mode",
            "votes"]
    return obs.table_digest(observations(spark, sf_dir), cols, scope=["election_id"])


@query("total_crosscheck", """
WITH a AS (SELECT l_returnflag, l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) v
           FROM lineitem GROUP BY ALL),
b AS (SELECT l_returnflag, l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) v
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' GROUP BY ALL)
SELECT coalesce(a.l_returnflag, b.l_returnflag) AS choice_name,
       count(*) FILTER (a.v = b.v) AS matched_keys,
       CAST(coalesce(sum(b.v) FILTER (a.v = b.v), 0) AS BIGINT) AS matched_votes,
       count(*) FILTER (a.v IS NULL) AS only_right, count(*) FILTER (b.v IS NULL) AS only_left,
       count(*) FILTER (a.v <> b.v) AS different,
       bool_and(coalesce(a.v = b.v, false)) AS crosschecked
FROM a FULL JOIN b ON a.l_returnflag = b.l_returnflag AND a.l_suppkey = b.l_suppkey GROUP BY ALL
""")
def crosscheck(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_suppkey").alias("reporting_unit_id"),
        F.col("l_returnflag").alias("choice_name"), F.col("l_quantity").cast("long").alias("v"))
    keys = ["choice_name", "reporting_unit_id"]
    settled = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select("o_orderkey")
    left = li.groupBy(*keys).agg(F.sum("v").alias("votes"))
    right = (li.join(settled, li.l_orderkey == settled.o_orderkey).groupBy(*keys)
             .agg(F.sum("v").alias("votes")))
    return obs.total_crosscheck(left, right, ["reporting_unit_id"], scope=["choice_name"])


# A rule table over the data's own labels, with a tie on label O in source 4.
_MODE_ROWS = [
    ("F", None, None, "election_day", "component", "literal", "e1", "verified", 0),
    ("O", None, None, "mail", "component", "literal", "e2", "verified", 1),
    ("O", "AA", None, "absentee", "component", "state", "e3", "verified", 2),
    ("O", None, "4", "early", "component", "source", "e4", "verified", 3),
    ("O", "AA", "4", "total", "aggregate", "both", "e5", "candidate", 4),
    ("F", "BB", "1", "provisional", "component", "both", "e6", "verified", 5),
]


@query("mode_resolution", """
WITH rules(raw, st, src, vote_mode, aggregation, evidence) AS (VALUES
  ('F', NULL, NULL, 'election_day', 'component', 'e1'), ('O', NULL, NULL, 'mail', 'component', 'e2'),
  ('O', 'AA', NULL, 'absentee', 'component', 'e3'), ('O', NULL, '4', 'early', 'component', 'e4'),
  ('F', 'BB', '1', 'provisional', 'component', 'e6')),
k AS (SELECT l_linestatus AS raw, CASE WHEN l_suppkey % 3 = 0 THEN 'AA' WHEN l_suppkey % 3 = 1
             THEN 'BB' ELSE 'CC' END AS st, CAST(l_suppkey % 5 AS VARCHAR) AS src,
             count(*) AS n FROM lineitem GROUP BY ALL),
m AS (SELECT k.*, r.vote_mode, r.evidence,
             dense_rank() OVER (PARTITION BY k.raw, k.st, k.src ORDER BY
               (r.st IS NOT NULL)::INT + (r.src IS NOT NULL)::INT DESC) AS rk
      FROM k JOIN rules r ON k.raw = r.raw AND (r.st IS NULL OR r.st = k.st)
       AND (r.src IS NULL OR r.src = k.src)),
best AS (SELECT raw, st, src, min(vote_mode) AS vote_mode, min(evidence) AS evidence
         FROM m WHERE rk = 1 GROUP BY ALL HAVING count(DISTINCT vote_mode) = 1)
SELECT k.raw AS raw_mode, k.st AS state, k.src AS source, best.vote_mode, best.evidence, k.n AS rows
FROM k LEFT JOIN best USING (raw, st, src)
""")
def mode_resolution(spark, sf_dir):
    from tallyweave.session import fixed_table
    rules = fixed_table(spark, _MODE_ROWS, modes.RULE_SCHEMA)
    third = F.col("l_suppkey") % 3
    rows = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_linestatus").alias("raw_mode"),
                F.when(third == 0, "AA").when(third == 1, "BB").otherwise("CC").alias("state"),
                (F.col("l_suppkey") % 5).cast("string").alias("source"))
    )
    out = modes.resolve_modes(rows, "raw_mode", F.col("state"), F.col("source"), rules)
    return out.groupBy("raw_mode", "state", "source", "vote_mode",
                       F.col("vote_mode_evidence_reference").alias("evidence")).agg(
        F.count(F.lit(1)).alias("rows"))


@query("mode_rule_conflicts", """
SELECT lower(p_brand) AS label, CAST(count(DISTINCT p_type) AS BIGINT) AS meanings
FROM (SELECT replace(p_brand, '#', ' ') AS p_brand, p_type FROM part) GROUP BY ALL
HAVING count(DISTINCT p_type) > 1
""")
def mode_rule_conflicts(spark, sf_dir):
    rules = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("raw_label"), F.lit(None).cast("string").alias("state"),
        F.lit(None).cast("string").alias("source_id"), F.col("p_type").alias("vote_mode"),
        F.lit("component").alias("aggregation"), F.lit("m").alias("mapping_method"),
        F.lit("e").alias("evidence_reference"), F.lit("verified").alias("status"))
    return modes.rule_conflicts(rules).select("label", "meanings")


@query("multilevel_reconcile", f"""
WITH {O_SQL},
u AS (SELECT jurisdiction_id, source_id, contest_name, choice_name, vote_mode,
      CAST(split_part(reporting_unit_id, ':', 2) AS BIGINT) AS n, CAST(sum(votes) AS BIGINT) AS v
      FROM o GROUP BY ALL),
lower1 AS (SELECT jurisdiction_id AS k, contest_name, choice_name, sum(v) AS s FROM u
           WHERE n % 7 <> 0 GROUP BY ALL),
up1 AS (SELECT jurisdiction_id AS k, contest_name, choice_name, sum(v) AS p FROM u GROUP BY ALL),
lower2 AS (SELECT source_id AS k, contest_name, choice_name, sum(v) AS s FROM u GROUP BY ALL),
up2 AS (SELECT source_id AS k, contest_name, choice_name, sum(v) AS p FROM u
        WHERE vote_mode = 'mail' GROUP BY ALL)
SELECT 'nation' AS level, k AS level_key, contest_name, choice_name,
       CAST(coalesce(s, 0) AS BIGINT) AS lower_sum, CAST(p AS BIGINT) AS published,
       CAST(coalesce(s, 0) - p AS BIGINT) AS residual
FROM up1 LEFT JOIN lower1 USING (k, contest_name, choice_name)
UNION ALL
SELECT 'region', k, contest_name, choice_name, CAST(coalesce(s, 0) AS BIGINT), CAST(p AS BIGINT),
       CAST(coalesce(s, 0) - p AS BIGINT)
FROM up2 LEFT JOIN lower2 USING (k, contest_name, choice_name)
""")
def multilevel(spark, sf_dir):
    o = observations(spark, sf_dir)
    number = F.split("reporting_unit_id", ":")[1].cast("long")
    none = F.lit(None).cast("string")
    units = o.filter(number % 7 != 0).select(
        F.lit("unit").alias("level"), F.col("reporting_unit_id").alias("level_key"),
        F.col("jurisdiction_id").alias("parent_key"), "contest_name", "choice_name", "votes")
    nations = o.select(F.lit("nation").alias("level"),
                       F.col("jurisdiction_id").alias("level_key"),
                       F.col("source_id").alias("parent_key"), "contest_name", "choice_name",
                       "votes")
    regions = o.filter("vote_mode = 'mail'").select(
        F.lit("region").alias("level"), F.col("source_id").alias("level_key"),
        none.alias("parent_key"), "contest_name", "choice_name", "votes")
    return obs.multilevel_reconcile(units.unionByName(nations).unionByName(regions),
                                    ["unit", "nation", "region"])
