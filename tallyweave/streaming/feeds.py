"""Feed captures as a stream: ingest once, accept against a baseline, log attempts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyweave.operators import history, observations as O
from tallyweave.session import write_once
from tallyweave.streaming.current import CurrentTable

FACT_COLUMNS = ["source_id", "config", "captured_at", "sha256", *O.CAPTURE_KEY, "votes"]


def capture_stream(spark: SparkSession, path: str, schema: T.StructType,
                   max_files: int = 1000) -> DataFrame:
    """Landed capture files as a stream with a bounded number of files per batch."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .parquet(path))


def ingest_batch(batch: DataFrame, batch_id: int, root: str, at: str = "captured_at",
                 keys: tuple[str, ...] = ("source_id", "sha256")) -> None:
    """Land each source's bytes once, whatever their age or lateness.

    The landed table itself is the memory: a batch keeps the first capture of each source and
    digest and drops those that an earlier batch landed. A repeated batch replaces its folder.
    """
    names = list(keys)
    body = F.struct(at, *[c for c in batch.columns if c not in (at, *names)])
    fresh = batch.groupBy(*names).agg(F.min(body).alias("_first")).select(*names, "_first.*")
    landed = _table(batch.sparkSession, f"{root}/landed", below=batch_id)
    if landed is not None:
        seen = landed.select(*[F.col(k).alias(f"_k_{k}") for k in names])
        same = F.lit(True)
        for k in names:
            same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        fresh = fresh.join(seen, same, "left_anti")
    fresh.write.mode("overwrite").parquet(f"{root}/landed/batch={batch_id:09d}")


def _table(spark: SparkSession, folder: str, below: int | None = None) -> DataFrame | None:
    """Rows of a table written batch by batch, up to a batch; null before the first one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    rows = spark.read.parquet(folder)
    return rows if below is None else rows.filter(F.col("batch") < below)


def run_available(writer) -> None:
    """Run a streaming write over everything that is there, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


VERDICT = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("captured_at", T.TimestampType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("warnings", T.StringType()),
    T.StructField("added_rows", T.LongType()),
    T.StructField("removed_rows", T.LongType()),
    T.StructField("changed_rows", T.LongType()),
    T.StructField("decreased_rows", T.LongType()),
    T.StructField("common_rows", T.LongType()),
])


class BaselineProcessor(StatefulProcessor):
    """Accepted baseline per source as keyed state.

    The accepted votes are map state, so the state store and not a task holds the baseline. The
    latest sample and the last accepted one are two separate value states; a new configuration
    clears them. Rows of one key come in batches that are read one at a time; a source's
    capture is compared once all its rows of this trigger have been seen.
    """

    def __init__(self, cumulative: bool = True) -> None:
        self.cumulative = cumulative

    def init(self, handle: StatefulProcessorHandle) -> None:
        key = T.StructType([T.StructField("k", T.StringType())])
        votes = T.StructType([T.StructField("votes", T.LongType())])
        mark = T.StructType([T.StructField("sha256", T.StringType()),
                             T.StructField("config", T.StringType())])
        self.baseline = handle.getMapState("baseline", key, votes)
        self.accepted = handle.getValueState("accepted", mark)
        self.latest = handle.getValueState("latest", mark)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        captures: dict = {}
        for batch in rows:
            names = batch[O.CAPTURE_KEY].astype(object).where(batch[O.CAPTURE_KEY].notna(), None)
            texts = ["\x1f".join("\x00" if v is None else str(v) for v in r)
                     for r in names.itertuples(index=False)]
            for at, sha, config, text, votes in zip(batch["captured_at"], batch["sha256"],
                                                    batch["config"], texts, batch["votes"]):
                captures.setdefault((at, sha, config), {})[text] = int(votes)
        out = [self._judge(key[0], at, sha, config, new)
               for (at, sha, config), new in sorted(captures.items())]
        yield pd.DataFrame(out, columns=[f.name for f in VERDICT])

    def _judge(self, source, at, sha, config, new):
        if self.latest.exists() and self.latest.get()[1] != config:
            self.baseline.clear()
            self.accepted.clear()
        known = self.accepted.exists()
        counts = dict.fromkeys(("added", "removed", "changed", "decreased", "common"), 0)
        for text, votes in new.items():
            if not self.baseline.containsKey((text,)):
                counts["added"] += 1
                continue
            before = self.baseline.getValue((text,))[0]
            counts["common"] += 1
            counts["changed"] += before != votes
            counts["decreased"] += self.cumulative and votes < before
        gone = [k[0] for k in self.baseline.keys() if k[0] not in new]
        counts["removed"] = len(gone)
        warnings = [name for name, hit in (
            ("rows_disappeared", counts["removed"]),
            ("cumulative_votes_decreased", counts["decreased"]),
            ("identity_discontinuity", known and not counts["common"])) if hit]
        self.latest.update((sha, config))
        if not warnings:
            for text, votes in new.items():
                self.baseline.updateValue((text,), (votes,))
            self.accepted.update((sha, config))
        return [source, at, sha, "review_required" if warnings else "ok", "|".join(warnings),
                *[counts[c] for c in ("added", "removed", "changed", "decreased", "common")]]

    def close(self) -> None:
        pass


def stateful_verdicts(facts: DataFrame, cumulative: bool = True) -> DataFrame:
    """Verdict stream of captures against their source's accepted baseline.

    For sources whose captures fit a task; ``accept_batch`` is the form for huge captures.
    """
    return facts.select(*FACT_COLUMNS).groupBy("source_id").transformWithStateInPandas(
        statefulProcessor=BaselineProcessor(cumulative), outputStructType=VERDICT,
        outputMode="Append", timeMode="None")


MAX_ROUNDS = 1_000_000  # Batch folders are numbered batch * MAX_ROUNDS + round.


def accept_batch(spark: SparkSession, batch: DataFrame, batch_id: int, root: str, *,
                 cumulative: bool = True) -> None:
    """One micro-batch of captures against the accepted baseline table.

    Works with joins and aggregates only, so a capture of any size is spread over tasks. Several
    captures of a source in the batch are judged in rounds, by time and digest, each against
    what its source had accepted before it; a new configuration starts a new baseline. Every
    round writes its own folder, so repeating a batch after a failure replaces its output.
    """
    facts = batch.select(*FACT_COLUMNS)
    # A window over the captures of one source in one trigger, not over their rows.
    order = Window.partitionBy("source_id").orderBy("captured_at", "sha256", "config")
    marks = facts.select("source_id", "captured_at", "sha256", "config").distinct()
    marks = write_once(marks.withColumn("_round", F.row_number().over(order)))
    rounds = marks.agg(F.max("_round")).first()[0] or 0
    if rounds >= MAX_ROUNDS:
        raise ValueError("too many captures of one source in a batch")
    for number in range(1, rounds + 1):
        mark = marks.filter(F.col("_round") == number)
        same = ["source_id", "captured_at", "sha256", "config"]
        cond = F.lit(True)
        for c in same:
            cond = cond & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        chosen = facts.join(mark.select(*[F.col(c).alias(f"_k_{c}") for c in same]), cond,
                            "left_semi")
        _accept_round(spark, chosen, mark.drop("_round"), batch_id * MAX_ROUNDS + number,
                      batch_id * MAX_ROUNDS, root, cumulative)


def _baseline(spark: SparkSession, root: str) -> CurrentTable:
    return CurrentTable(spark, f"{root}/accepted", ["source_id"])


def _accept_round(spark: SparkSession, facts: DataFrame, marks: DataFrame, step: int, since: int,
                  root: str, cumulative: bool) -> None:
    """Judge at most one capture per source, log it, and let it replace its source's baseline if
    accepted. Only the parts of the baseline that hold these sources are read and written."""
    table = _baseline(spark, root)
    touched = table.touched(marks)
    before = table.read(step, touched)
    if before is None:
        before = facts.limit(0)
    config = marks.select("source_id", F.col("config").alias("_config"))
    old = before.join(config, "source_id").filter(F.col("config").eqNullSafe(F.col("_config")))
    summary = O.capture_warnings(O.change_summary(
        old.drop("_config"), facts, cumulative=cumulative, scope=["source_id"]))
    verdicts = marks.join(summary, "source_id").withColumn(
        "warnings", F.array_join("warnings", "|"))
    verdicts.write.mode("overwrite").parquet(f"{root}/attempts/batch={step:015d}")
    ok = spark.read.schema(verdicts.schema).parquet(
        f"{root}/attempts/batch={step:015d}").filter("status = 'ok'")
    accepted = facts.join(ok.select("source_id"), "source_id", "left_semi")
    kept = before.join(ok.select("source_id"), "source_id", "left_anti")
    table.replace(step, kept.unionByName(accepted).select(*FACT_COLUMNS), touched, since)


def accepted_baseline(spark: SparkSession, root: str, below: int | None = None
                      ) -> DataFrame | None:
    """Rows of each source's last accepted capture (T5); null before the first batch."""
    return _baseline(spark, root).read(below)


def stream_accept(spark: SparkSession, captures: DataFrame, root: str, checkpoint: str,
                  cumulative: bool = True) -> None:
    """Run the accept step over all landed captures and stop."""
    writer = captures.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, n: accept_batch(spark, df, n, root, cumulative=cumulative))
    run_available(writer)


def attempt_status(spark: SparkSession, root: str, now: Column, stale_after: Column,
                   interval: Column) -> DataFrame:
    """Status of every feed from the attempts log."""
    log = spark.read.parquet(f"{root}/attempts")
    rows = log.select("source_id", F.unix_seconds("captured_at").alias("at"),
                      F.col("batch").cast("long").alias("seq"), "status")
    return history.feed_status(rows, ["source_id"], "at", "seq", now, stale_after, interval)


def ledger_batch(spark: SparkSession, batch: DataFrame, batch_id: int, root: str,
                 keys: list[str], at: str, arrival: str) -> None:
    """Fold one micro-batch into the source ledger, refusing rows older than the ledger.

    Refused rows go to a side table. Only the parts of the ledger that hold the batch's keys are read and
    written; a repeated batch starts from the ledger before it and gives the same again.
    """
    table = CurrentTable(spark, f"{root}/ledger", keys)
    touched = table.touched(batch)
    current = table.read(batch_id, touched)
    rows = history.out_of_order(batch, keys, at, arrival)
    if current is not None:
        seen = current.select(*keys, F.col("last_checked_at").alias("_seen"))
        rows = rows.join(seen, keys, "left").withColumn(
            "refused", F.col("refused") | F.coalesce(F.col(at) < F.col("_seen"), F.lit(False))
        ).drop("_seen")
    rows.filter("refused").write.mode("overwrite").parquet(f"{root}/refused/batch={batch_id:09d}")
    fold = history.fold_ledger(rows.filter("not refused"), keys, at, arrival)
    merged = fold if current is None else history.merge_ledger(current, fold, keys)
    table.replace(batch_id, merged, touched, batch_id)


def current_ledger(spark: SparkSession, root: str, keys: list[str]) -> DataFrame | None:
    """The source ledger as of the last batch; null before the first."""
    return CurrentTable(spark, f"{root}/ledger", keys).read()
