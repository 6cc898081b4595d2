"""Queries that land rows twice and read back one copy, and rules and digests of single rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.functions import ids, urls as U
from tallyweave.operators import catalog as K, history as Y, links as L, quality as Q
from tallyweave.plans.registry import query
from tallyweave.plans.views import table
from tallyweave.session import checkpoint_dir
from tallyweave.sources import captures as S, commit, registry as G


def _folder(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("landed_captures", """
SELECT sha256(html) AS sha256, count(DISTINCT html) AS copies, min(url) AS path FROM pages GROUP BY ALL
""")
def landed_captures(spark, sf_dir):
    """Pages land in two runs that overlap, and the second again; equal bytes land once."""
    own = table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("path"), F.col("html").cast("binary").alias("content"))
    own = own.withColumn("sha256", F.sha2("content", 256))
    first = own.groupBy("sha256").agg(F.min("path").alias("_p"), F.min("page_id").alias("_id"))
    own = own.join(first.filter("_id % 2 = 0").select("sha256", F.lit(True).alias("_early")),
                   "sha256", "left")
    early = own.filter("_early").drop("_early", "page_id")
    folder = _folder(spark, "landed")
    for part in (early, own.drop("_early", "page_id"), own.drop("_early", "page_id")):
        S.land_once(part, folder)
    landed = commit.committed(spark, folder)
    bad = S.tampered(landed).select("sha256")
    return landed.join(bad, "sha256", "left_anti").groupBy("sha256").agg(
        F.count(F.lit(1)).alias("copies"), F.min("path").alias("path"))


@query("integrity_sink", """
WITH r AS (SELECT l_orderkey, sum(l_quantity) >= 100 AS reconciles FROM lineitem GROUP BY ALL)
SELECT (SELECT count(*) FROM lineitem) AS observations, count(*) AS reconciliation_rows, count(*) FILTER (NOT reconciles) AS unreconciled_rows,
  (SELECT count(*) FROM orders) AS deltas FROM r
""")
def integrity_sink(spark, sf_dir):
    facts = table(spark, sf_dir, "lineitem")
    checked = facts.groupBy("l_orderkey").agg((F.sum("l_quantity") >= 100).alias("reconciles"))
    deltas = table(spark, sf_dir, "orders").select("o_orderkey")
    folder = _folder(spark, "integrity")
    for _ in range(2):
        G.write_integrity(folder, reconciliation=checked, deltas=deltas, facts=facts)
    return commit.committed(spark, f"{folder}/summary")


_CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_acctbal", T.DoubleType()), T.StructField("rich", T.BooleanType()),
    T.StructField("absent", T.StringType())])


@query("registry_sink", """
SELECT c_custkey, CASE WHEN c_custkey % 7 > 0 THEN c_name || ', "x"' END AS c_name, c_acctbal, c_acctbal > 0 AS rich, CAST(NULL AS VARCHAR) AS absent FROM customer
""")
def registry_sink(spark, sf_dir):
    """Customers as a registry file, written twice and read with types; every seventh name is blank."""
    name = F.when(F.col("c_custkey") % 7 > 0, F.concat("c_name", F.lit(', "x"')))
    own = table(spark, sf_dir, "customer").select(
        "c_custkey", name.alias("c_name"), "c_acctbal",
        F.when(F.col("c_acctbal") > 0, "yes").otherwise("no").alias("rich"))
    folder = _folder(spark, "registry")
    for _ in range(2):
        G.write_registry(own, folder, ["c_name", "c_custkey"])
    return G.read_registry(spark, folder, _CUSTOMER)


@query("replay_sink", """
SELECT o_orderkey, o_custkey, o_orderstatus, (SELECT count(*) FROM orders) AS digest_rows FROM orders
""")
def replay_sink(spark, sf_dir):
    facts = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    folder = _folder(spark, "replay")
    for _ in range(2):
        G.write_replay(facts.repartition(3), folder, facts.columns)
    digest = commit.committed(spark, f"{folder}/digest").select(
        F.col("row_count").alias("digest_rows"))
    # One row: the digest.
    return commit.committed(spark, f"{folder}/rows").crossJoin(F.broadcast(digest))


@query("event_journal", """
SELECT event_id, user_id, event_type FROM events
""")
def event_journal(spark, sf_dir):
    """Events in two batches, each written twice, and the journal's newest rows found in it."""
    own = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    folder = _folder(spark, "journal")
    for odd in (0, 1, 1, 0):
        G.append_events(own.filter(F.col("event_id") % 2 == odd), folder)
    journal = commit.committed(spark, folder)
    newest = Y.latest_events(journal, "event_id", 100)
    older = journal.join(newest.select("event_id"), "event_id", "left_anti")
    return older.unionByName(newest)


@query("canonical_digests", r"""
SELECT c_custkey, sha256(c_name) AS content, sha256('{"c_custkey":' || c_custkey || ',"c_name":' || CASE WHEN c_custkey % 5 = 0 THEN 'null' ELSE '"' || c_name || '"' END
  || ',"c_nationkey":' || c_nationkey || '}') AS canonical FROM customer
""")
def canonical_digests(spark, sf_dir):
    own = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", ids.content_digest(F.col("c_name")).alias("content"),
        F.when(F.col("c_custkey") % 5 > 0, F.col("c_name")).alias("c_name"))
    return own.select("c_custkey", "content", ids.canonical_json_digest(
        "c_nationkey", "c_name", "c_custkey").alias("canonical"))


_LEADS = """
e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN ' ' ELSE 'r' || CAST(event_id AS VARCHAR) END AS rid,
        CASE user_id % 4 WHEN 0 THEN 'https://a.co.gov/x' WHEN 1 THEN 'http://gov/x' WHEN 2 THEN 'ftp://b.gov' ELSE 'https://gov.example.org/a.gov' END AS url,
        CASE event_type WHEN 'click' THEN 'verified_official' ELSE 'unknown' END AS status,
        CASE event_type WHEN 'view' THEN 'manual' ELSE 'research_repository' END AS origin, CASE WHEN value > 50 THEN 'n' END AS notes FROM events)
"""


def _leads(spark, sf_dir):
    k = F.col("user_id") % 4
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 7 == 0, " ").otherwise(
            F.concat(F.lit("r"), "event_id")).alias("source_record_id"),
        F.when(k == 0, "https://a.co.gov/x").when(k == 1, "http://gov/x").when(k == 2, "ftp://b.gov")
        .otherwise("https://gov.example.org/a.gov").alias("lead_url"),
        F.when(F.col("event_type") == "click", "verified_official").otherwise("unknown")
        .alias("official_status"),
        F.when(F.col("event_type") == "view", "manual").otherwise("research_repository")
        .alias("origin"), F.when(F.col("value") > 50, "n").alias("notes"))


@query("lead_violations", f"""
WITH {_LEADS}
SELECT event_id, 'record_id_missing' AS rule_id FROM e WHERE rid = ' '
UNION ALL SELECT event_id, 'url_not_http' FROM e WHERE url LIKE 'ftp%'
UNION ALL SELECT event_id, 'verified_without_notes' FROM e WHERE status = 'verified_official' AND origin = 'research_repository' AND notes IS NULL
""")
def lead_violations(spark, sf_dir):
    return Q.violations(_leads(spark, sf_dir), ["event_id"], Q.lead_rules())


@query("official_leads", f"""
WITH {_LEADS}
SELECT event_id, url NOT LIKE '%example%' AS official, CASE WHEN url LIKE '%example%' THEN 'unknown' ELSE 'likely_official' END AS status FROM e
""")
def official_leads(spark, sf_dir):
    url = F.col("lead_url")
    return _leads(spark, sf_dir).select("event_id", U.official_host(url).alias("official"),
                                        U.lead_status(url).alias("status"))


@query("provenance_violations", """
WITH o AS (SELECT o_orderkey AS k, 's' || CAST(o_custkey % 9 AS VARCHAR) AS s, sha256(CAST(o_custkey AS VARCHAR)) AS h, o_orderkey % 4 = 0 AS lost FROM orders),
n AS (SELECT DISTINCT s, h FROM o WHERE NOT lost)
SELECT CAST(k AS VARCHAR) AS id, 'missing_provenance' AS rule_id FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.s = o.s AND n.h = o.h)
UNION ALL SELECT s, 'missing_body' FROM n WHERE h < '8'
UNION ALL SELECT 'stamped', CAST(count(*) FILTER (s = 's3') AS VARCHAR) FROM o
UNION ALL SELECT 'refused', CAST(count(*) FILTER (s <> 's3') AS VARCHAR) FROM o
""")
def provenance_violations(spark, sf_dir):
    own = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("s"), F.col("o_custkey") % 9).alias("source_id"),
        F.sha2(F.col("o_custkey").cast("string"), 256).alias("snapshot_sha256"),
        (F.col("o_orderkey") % 4 == 0).alias("lost"))
    landed = own.filter("not lost").select(
        "source_id", F.col("snapshot_sha256").alias("sha256")).distinct()
    landed = landed.withColumn("body_path", F.when(F.col("sha256") < "8", " ").otherwise("p"))
    gaps = Q.missing_provenance(own, landed).select("id", F.lit("missing_provenance").alias("rule_id"))
    shape = Q.violations(landed, ["source_id"], Q.snapshot_rules()).withColumnRenamed("source_id", "id")
    stamped, refused = Q.attach_snapshot(own, "s3", "0" * 64)
    count = lambda df, name: df.agg(F.count(F.lit(1)).cast("string").alias("rule_id")).select(
        F.lit(name).alias("id"), "rule_id")
    return gaps.unionByName(shape).unionByName(
        count(stamped.filter(F.col("snapshot_sha256") == "0" * 64), "stamped")).unionByName(
        count(refused, "refused"))


@query("self_aliases", """
SELECT c_name, CASE WHEN c_custkey % 3 = 1 THEN 'other' END AS canonical_id, 'identity_not_self' AS rule_id FROM customer WHERE c_custkey % 3 > 0
""")
def self_aliases(spark, sf_dir):
    k = F.col("c_custkey") % 3
    own = table(spark, sf_dir, "customer").select(
        "c_name", F.when(k == 0, F.col("c_name")).when(k == 1, "other").alias("canonical_id"))
    return Q.self_alias_violations(own, "c_name")


@query("csv_directory", """
WITH c AS (SELECT c_custkey AS row_number, c_nationkey AS n, n_regionkey AS r, c_custkey % 4 AS u FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT row_number, CASE WHEN row_number % 2 = 0 OR r = 0 THEN 'us:nation:' || CAST(n AS VARCHAR) ELSE '' END AS ids,
  CASE u WHEN 0 THEN 'artifact_lead' WHEN 1 THEN 'directory_anchor' ELSE CASE WHEN row_number % 2 = 0 OR r = 0 THEN 'unit_label_candidate' ELSE 'unmatched_directory_link' END END AS match_status
FROM c WHERE u < 3 AND (u = 2 OR row_number % 2 = 0 OR r = 0)
""")
def csv_directory(spark, sf_dir):
    """Each customer is a row that names its nation; odd rows claim to be of region 0's state."""
    nation = table(spark, sf_dir, "nation")
    units = nation.select(
        F.concat(F.lit("us:nation:"), F.col("n_nationkey")).alias("jurisdiction_id"),
        F.concat(F.lit("S"), F.col("n_regionkey")).alias("state"),
        F.col("n_name").alias("canonical_name"), F.lit("county").alias("jurisdiction_level"))
    k = F.col("c_custkey")
    site = (F.when(k % 4 == 0, "https://u.example.org/a.PDF").when(k % 4 == 1, "https://s.gov/a.csv")
            .when(k % 4 == 2, F.concat(F.lit("HTTPS://e.example.org/clerk/"), k)).otherwise("u.example.org"))
    rows = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        k.alias("row_number"), F.when(k % 2 == 0, F.concat(F.lit("S"), F.col("n_regionkey")))
        .otherwise("S0").alias("state"),
        F.concat(F.lit("Office of "), F.col("n_name")).alias("name"), site.alias("site"))
    out = L.csv_directory(rows, units, F.lit("https://s.gov/a.csv"), "name", "site")
    return out.select("row_number", F.array_join("associated_unit_ids", "|").alias("ids"),
                      "match_status")


@query("merged_batches", """
SELECT o_orderkey AS k, o_orderstatus AS a, CAST(NULL AS VARCHAR) AS b FROM orders UNION ALL SELECT l_orderkey, NULL, l_returnflag FROM lineitem
""")
def merged_batches(spark, sf_dir):
    one = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"),
                                                F.col("o_orderstatus").alias("a"))
    two = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("b"),
                                                  F.col("l_orderkey").alias("k"))
    return K.merge_batches([one, two])
