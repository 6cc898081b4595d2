"""Base views over the given tables, as Spark plans and as the SQL the checks start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; times without a zone are read as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    naive = [f.name for f in df.schema if isinstance(f.dataType, TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O: line items as counts by unit, contest, choice and mode, one row per key.

    The two dimension joins come first, on the small supplier and nation tables; only needed
    columns are read.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    mode = F.when(F.col("l_linestatus") == "F", "election_day").otherwise("mail")
    return (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .join(supplier, li.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
        .groupBy(
            F.year("o_orderdate").cast("string").alias("election_id"),
            F.concat(F.lit("us:"), F.lower("n_name")).alias("jurisdiction_id"),
            F.concat(F.lit("unit:"), F.col("l_suppkey")).alias("reporting_unit_id"),
            F.col("o_orderpriority").alias("contest_name"),
            F.col("l_returnflag").alias("choice_name"),
            mode.alias("vote_mode"),
            F.concat(F.lit("region:"), F.col("n_regionkey")).alias("source_id"),
        )
        .agg(F.sum(F.col("l_quantity").cast("long")).alias("votes"))
    )


O_SQL = """
o AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS election_id,
         'us:' || lower(n_name) AS jurisdiction_id,
         'unit:' || CAST(l_suppkey AS VARCHAR) AS reporting_unit_id,
         o_orderpriority AS contest_name, l_returnflag AS choice_name,
         CASE WHEN l_linestatus = 'F' THEN 'election_day' ELSE 'mail' END AS vote_mode,
         'region:' || CAST(n_regionkey AS VARCHAR) AS source_id,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS votes
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL)
"""


def with_totals(obs: DataFrame) -> DataFrame:
    """O-total: adds a total row to keys whose unit number is a multiple of three."""
    number = F.split("reporting_unit_id", ":")[1].cast("long")
    totals = obs.filter(number % 3 == 0).withColumn("vote_mode", F.lit("total"))
    return obs.unionByName(totals)


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P: events as cumulative source counts by user and event type."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.lit("e1").alias("election_id"),
        F.concat(F.lit("us:user:"), F.col("user_id")).alias("jurisdiction_id"),
        F.col("event_type").alias("source_id"),
        F.lit("source").alias("scope"),
        F.lit(None).cast("string").alias("reporting_unit_id"),
        F.lit(None).cast("string").alias("contest_id"),
        F.when(F.col("event_id") % 5 == 0, "source_complete").otherwise("source_counts")
        .alias("kind"),
        F.lit("cumulative").alias("update_semantics"),
        F.when(F.col("event_id") % 5 != 0, F.floor("value")).alias("reporting_count"),
        F.when(F.col("event_id") % 5 != 0, F.get_json_object("props", "$.k").cast("long"))
        .alias("expected_count"),
        F.when(F.col("event_id") % 5 == 0, F.get_json_object("props", "$.k").cast("long") >= 50)
        .alias("complete"),
        F.col("ts").alias("fetched_at"),
        F.lit(None).cast("timestamp").alias("source_timestamp"),
        F.col("event_id").alias("seq"),
    )


P_SQL = """
p AS (
  SELECT 'us:user:' || CAST(user_id AS VARCHAR) AS jurisdiction_id, event_type AS source_id,
         CASE WHEN event_id % 5 = 0 THEN 'source_complete' ELSE 'source_counts' END AS kind,
         CASE WHEN event_id % 5 <> 0 THEN CAST(floor(value) AS BIGINT) END AS reporting_count,
         CASE WHEN event_id % 5 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END
           AS expected_count,
         CASE WHEN event_id % 5 = 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50
           END AS complete, ts, event_id AS seq
  FROM events)
"""


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I: orders as dated, verified aliases of customers.

    The priority stands for the identity an alias points to; ``URGENT`` rows carry no dates.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    day = F.to_date("o_orderdate")
    timeless = F.col("o_orderkey") % 10 == 0
    return o.select(
        F.lit("jurisdiction").alias("object_type"),
        F.concat(F.lit("id:"), F.col("o_orderpriority")).alias("canonical_id"),
        F.lit("external_id").alias("alias_kind"),
        F.concat(F.lit(" Customer "), F.col("o_custkey")).alias("alias_value"),
        F.lit("Orders").alias("alias_namespace"),
        F.when(F.col("o_orderstatus") == "P", "candidate").otherwise("verified").alias("status"),
        F.when(~timeless, day).alias("effective_from"),
        F.when(~timeless, F.date_add(day, 60)).alias("effective_to"),
        F.col("o_orderkey").alias("decision_id"),
    )


I_SQL = """
i AS (
  SELECT 'id:' || o_orderpriority AS canonical_id,
         'customer-' || CAST(o_custkey AS VARCHAR) AS alias,
         CASE WHEN o_orderstatus = 'P' THEN 'candidate' ELSE 'verified' END AS status,
         CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS effective_from,
         CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) + 60 END AS effective_to,
         o_orderkey AS decision_id
  FROM orders)
"""


def captured_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CP: each order as a captured page whose links are its line items.

    An order has a handful of lines, so collecting a page's links is bounded.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    li = li.join(supplier, li.l_suppkey == supplier.s_suppkey)
    part = F.col("l_partkey").cast("string")
    href = (
        F.when(F.col("l_returnflag") == "A",
               F.concat(F.lit("/results/"), part, F.lit(".csv?utm_source=x")))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("docs/"), part, F.lit(".pdf")))
        .otherwise(F.concat(F.lit("https://vendor"), (F.col("l_suppkey") % 3).cast("string"),
                            F.lit(".example.com/clerk/"), part))
    )
    label = F.concat(F.when(F.col("l_linestatus") == "O", "Canvass report ")
                     .otherwise("Official results "), F.col("l_linenumber").cast("string"))
    item = F.concat(F.lit("<li>NATION_"), F.col("s_nationkey").cast("string"),
                    F.lit(' clerk <a href="'), href, F.lit('">'), label, F.lit("</a></li>"))
    lists = li.groupBy("l_orderkey").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("l_linenumber", item.alias("item")))),
        lambda s: s.item), "").alias("items"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                   "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    title = F.when(F.col("o_orderstatus") == "F", "Election Results").when(
        F.col("o_orderstatus") == "O", "Access Denied").otherwise("Town &amp; Clerk")
    return (
        lists.join(orders, lists.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.col("o_orderkey").alias("page_id"),
            F.concat(F.lit("https://host"), F.col("c_nationkey").cast("string"),
                     F.lit(".example.gov/elections/"), F.col("o_orderkey").cast("string"))
            .alias("url"),
            F.concat(F.lit("S"), F.col("n_regionkey").cast("string")).alias("state"),
            "o_orderdate",
            F.concat(F.lit("<html><head><title>"), title, F.lit("</title></head><body><h1>"),
                     title, F.lit("</h1><ul>"), F.col("items"), F.lit("</ul></body></html>"))
            .alias("html"))
    )


CP_SQL = """
cpl AS (
  SELECT o_orderkey AS page_id, 'https://host' || CAST(c_nationkey AS VARCHAR) || '.example.gov' AS root,
         'https://host' || CAST(c_nationkey AS VARCHAR) || '.example.gov/elections/'
           || CAST(o_orderkey AS VARCHAR) AS url,
         'S' || CAST(n_regionkey AS VARCHAR) AS state, o_orderstatus, o_orderdate, l_linenumber,
         l_returnflag, l_linestatus, l_partkey, l_suppkey, s_nationkey,
         CASE l_returnflag WHEN 'A' THEN '/results/' || CAST(l_partkey AS VARCHAR) || '.csv?utm_source=x'
           WHEN 'N' THEN 'docs/' || CAST(l_partkey AS VARCHAR) || '.pdf'
           ELSE 'https://vendor' || CAST(l_suppkey % 3 AS VARCHAR) || '.example.com/clerk/'
             || CAST(l_partkey AS VARCHAR) END AS href,
         CASE l_returnflag WHEN 'A' THEN 'https://host' || CAST(c_nationkey AS VARCHAR)
             || '.example.gov/results/' || CAST(l_partkey AS VARCHAR) || '.csv'
           WHEN 'N' THEN 'https://host' || CAST(c_nationkey AS VARCHAR)
             || '.example.gov/elections/docs/' || CAST(l_partkey AS VARCHAR) || '.pdf'
           ELSE 'https://vendor' || CAST(l_suppkey % 3 AS VARCHAR) || '.example.com/clerk/'
             || CAST(l_partkey AS VARCHAR) END AS link,
         CASE l_linestatus WHEN 'O' THEN 'Canvass report ' ELSE 'Official results ' END
           || CAST(l_linenumber AS VARCHAR) AS label,
         CASE o_orderstatus WHEN 'F' THEN 'Election Results' WHEN 'O' THEN 'Access Denied'
           ELSE 'Town & Clerk' END AS title
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN supplier ON l_suppkey = s_suppkey)
"""
