"""Streaming queries over the given tables: land rounds of files, run each, return the table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyweave.plans.history import _CAPTURES
from tallyweave.plans.registry import query
from tallyweave.plans.views import O_SQL, observations, table
from tallyweave.session import checkpoint_dir, write_once
from tallyweave.streaming import feeds, pages

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _scratch(spark, name):
    """A new folder in the shared checkpoint location for one run."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _run_rounds(df, root, order, rounds, writer_of, batch_files=1000):
    """Land ``df`` in ranges of a long column and run the stream after each one.

    Every run goes on from the checkpoint of the last, so state and tables cross batches. Only
    the range limits reach the driver; the files of a range are written by all tasks.
    """
    df = write_once(df)
    cuts = [n / rounds for n in range(1, rounds)]
    limits = df.agg(F.percentile_approx(order, cuts)).first()[0] or []
    number = F.lit(0)
    for limit in limits:
        number = number + F.when(F.col(order) > limit, 1).otherwise(0)
    for n in range(rounds):
        df.filter(F.coalesce(number, F.lit(0)) == n).write.mode("append").parquet(
            f"{root}/landing")
        stream = feeds.capture_stream(df.sparkSession, f"{root}/landing", df.schema, batch_files)
        feeds.run_available(writer_of(stream).option("checkpointLocation", f"{root}/ckpt"))


@query("stream_dedupe", """
SELECT DISTINCT user_id AS source_id, event_type || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS VARCHAR) AS sha256 FROM events
""")
def stream_dedupe(spark, sf_dir):
    """The newest third arrives first: the rest is late by days and must still land once."""
    root = _scratch(spark, "dedupe")
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("source_id"), F.col("ts").alias("captured_at"),
        F.concat("event_type", F.get_json_object("props", "$.k").cast("long") % 5)
        .alias("sha256"), (-F.unix_micros("ts")).alias("_order"))
    _run_rounds(rows, root, "_order", 3, lambda stream: stream.drop("_order").writeStream
                .foreachBatch(lambda df, n: feeds.ingest_batch(df, n, root)))
    return spark.read.parquet(f"{root}/landed").select("source_id", "sha256")


@query("stream_diff", f"""
WITH RECURSIVE {O_SQL},
v AS (SELECT *, CAST(election_id AS INT) AS y FROM o),
sz AS (SELECT source_id, y, count(*) AS size FROM v GROUP BY ALL),
c AS (SELECT *, CASE WHEN y < 1995 THEN 'c1' ELSE 'c2' END AS cfg,
             row_number() OVER (PARTITION BY source_id ORDER BY y) AS n FROM sz),
p AS (SELECT a.source_id, a.y AS yo, b.y AS yn, count(*) AS common,
             count(*) FILTER (a.votes <> b.votes) AS changed,
             count(*) FILTER (b.votes < a.votes) AS decreased
      FROM v a JOIN v b USING (source_id, reporting_unit_id, contest_name, choice_name, vote_mode)
      WHERE a.y < b.y GROUP BY ALL),
r AS (SELECT source_id, n, y, y AS base, cfg AS bcfg, '' AS warnings, size AS added, 0 AS removed,
             0 AS changed, 0 AS decreased, 0 AS common FROM c WHERE n = 1
      UNION ALL
      SELECT source_id, n, y, CASE WHEN w = '' THEN y ELSE base END,
             CASE WHEN w = '' THEN cfg ELSE bcfg END, w, added, removed, changed, decreased, common
      FROM (SELECT *, concat_ws('|', CASE WHEN removed > 0 THEN 'rows_disappeared' END,
                     CASE WHEN decreased > 0 THEN 'cumulative_votes_decreased' END,
                     CASE WHEN removed > 0 AND common = 0 THEN 'identity_discontinuity' END) AS w
            FROM (SELECT c.source_id, c.n, c.y, c.cfg, r.base, r.bcfg,
                         c.size - coalesce(p.common, 0) AS added,
                         coalesce(b.size, 0) - coalesce(p.common, 0) AS removed,
                         coalesce(p.changed, 0) AS changed, coalesce(p.decreased, 0) AS decreased,
                         coalesce(p.common, 0) AS common
                  FROM r JOIN c ON c.source_id = r.source_id AND c.n = r.n + 1
                    LEFT JOIN sz b ON b.source_id = r.source_id AND b.y = r.base AND r.bcfg = c.cfg
                    LEFT JOIN p ON p.source_id = r.source_id AND p.yo = b.y AND p.yn = c.y)))
SELECT source_id, y AS year, CASE WHEN warnings = '' THEN 'ok' ELSE 'review_required' END AS status,
       warnings, CAST(added AS BIGINT) AS added_rows, CAST(removed AS BIGINT) AS removed_rows,
       CAST(changed AS BIGINT) AS changed_rows, CAST(decreased AS BIGINT) AS decreased_rows,
       CAST(common AS BIGINT) AS common_rows FROM r
""")
def stream_diff(spark, sf_dir):
    """Yearly observations as captures judged against the accepted baseline.

    Several years of a source land in one batch, and the configuration changes in 1995.
    """
    root = _scratch(spark, "diff")
    blank = F.lit(None).cast("string")
    year = F.col("election_id").cast("int")
    zero = F.lit(0)
    facts = observations(spark, sf_dir).select(
        "source_id", F.when(year < 1995, "c1").otherwise("c2").alias("config"),
        F.make_timestamp(year, F.lit(1), F.lit(1), zero, zero, zero.cast("decimal(8,6)"))
        .alias("captured_at"), F.sha2("election_id", 256).alias("sha256"), "reporting_unit_id",
        "contest_name", "choice_name", blank.alias("party"), "vote_mode",
        blank.alias("raw_vote_mode"), "votes", year.cast("long").alias("_order"))
    _run_rounds(facts, root, "_order", 3, lambda stream: stream.writeStream.foreachBatch(
        lambda df, n: feeds.accept_batch(spark, df, n, root)))
    return spark.read.parquet(f"{root}/attempts").select(
        "source_id", F.year("captured_at").alias("year"), "status", "warnings", "added_rows",
        "removed_rows", "changed_rows", "decreased_rows", "common_rows")


@query("stream_ledger", """
WITH e AS (SELECT user_id, epoch_us(date_trunc('day', ts)) AS tm, event_type <> 'error' AS ok,
           'error:' || json_extract_string(props, '$.k') AS fc,
           CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000000000 + event_id AS arrival FROM events),
a AS (SELECT * FROM e QUALIFY coalesce(tm >= max(tm) OVER (PARTITION BY user_id ORDER BY arrival
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true))
SELECT user_id, bool_or(ok) AS ever_verified, min(tm) FILTER (ok) AS first_verified_at,
       max(tm) FILTER (ok) AS last_verified_at, max(tm) AS last_checked_at,
       max(struct_pack(t := tm, a := arrival)).a AS last_arrival,
       arg_max(ok, (tm, arrival)) AS currently_reachable,
       arg_max(CASE WHEN ok THEN '' ELSE fc END, (tm, arrival)) AS last_failure_class
FROM a GROUP BY user_id
""")
def stream_ledger(spark, sf_dir):
    """Checks that arrive out of order, with many equal times, in three batches."""
    from tallyweave.plans.history import _source_checks
    root = _scratch(spark, "ledger")
    day = 86_400_000_000
    checks = _source_checks(spark, sf_dir).select(
        "user_id", (F.floor(F.col("at") / day) * day).alias("at"), "verified", "failure_class",
        (F.col("k") * 1_000_000_000 + F.col("event_id")).alias("arrival"))
    _run_rounds(checks, root, "arrival", 3, lambda stream: stream.writeStream.foreachBatch(
        lambda df, n: feeds.ledger_batch(spark, df, n, root, ["user_id"], "at", "arrival")))
    return feeds.current_ledger(spark, root, ["user_id"])


@query("stream_page_events", f"""
WITH {_CAPTURES}
SELECT CAST(page AS VARCHAR) AS page, tm AS observed_at, CASE WHEN pt IS NULL THEN 'baseline_captured' WHEN pd <> dg THEN 'page_changed'
       ELSE 'fingerprints_reclassified' END AS kind, CAST(page AS VARCHAR) AS link
FROM t WHERE pt IS NULL OR pd <> dg OR pr <> rd
UNION ALL
SELECT CAST(page AS VARCHAR), tm, CASE WHEN sb IS NULL THEN 'candidate_discovered' ELSE 'candidate_reappeared' END,
       CAST(link AS VARCHAR) FROM s WHERE sb IS NULL OR sb < pt
UNION ALL
SELECT CAST(page AS VARCHAR), nt, 'link_not_observed_this_capture', CAST(link AS VARCHAR) FROM s
WHERE nt IS NOT NULL AND (sn IS NULL OR sn > nt)
""")
def stream_page_events(spark, sf_dir):
    root = _scratch(spark, "pages")
    links = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_set((F.col("l_suppkey") % 20).cast("string")).alias("links"))
    micros = F.unix_micros("o_orderdate") + F.col("o_orderkey")
    none = F.array().cast("array<string>")
    captures = table(spark, sf_dir, "orders").join(
        links, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_custkey").cast("string").alias("page"),
        F.timestamp_micros(micros).alias("captured_at"),
        F.col("o_orderpriority").alias("digest"), F.col("o_orderstatus").alias("rules_digest"),
        F.coalesce("links", none).alias("links"), micros.alias("_order"))
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, ROCKS)
    try:
        _run_rounds(captures, root, "_order", 2, lambda stream: pages.watch_pages(
            stream.drop("_order")).writeStream.format("parquet").option("path", f"{root}/out")
            .outputMode("append"))
    finally:
        spark.conf.set(store, before)
    return spark.read.parquet(f"{root}/out").select(
        "page", F.unix_micros("captured_at").alias("observed_at"), "kind", "link")
