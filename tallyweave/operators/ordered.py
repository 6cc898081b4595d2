"""Queues and exports in one order over all rows, without one task that sorts them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.operators import frontier as Q
from tallyweave.session import write_once


def numbered(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Add each row's place from 1 in the order of all rows; equal ones follow by a hash of the row.

    Rows are dealt to ranges of the order and written once, so that ranges stay as they are. A row's place
    is its place in its range and the number of rows in the ranges before it: one number per range.
    """
    hashable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    tied = df.withColumn("_tie", F.xxhash64(*hashable))
    place = [*order, F.col("_tie").asc()]
    laid = write_once(tied.repartitionByRange(*place).withColumn("_range", F.spark_partition_id()))
    counts = laid.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("_range").alias("_k"), F.coalesce(
        F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*place))
    rows = laid.withColumn("_own", own).join(
        F.broadcast(counts), F.col("_range") == F.col("_k"))
    return rows.select(*df.columns, (F.col("_before") + F.col("_own")).alias(name))


def priority_queue(rows: DataFrame, priority: str, state: str = "state") -> DataFrame:
    """Rows by priority, the highest first, then by state (K7)."""
    return numbered(rows, [F.col(priority).desc(), F.col(state).asc()], "queue_position")


def frontier_export(frontier: DataFrame, limit: int = 20) -> DataFrame:
    """The frontier in the order of its units, and each unit's turn in the search queue.

    ``queue_turn`` is null for units outside the queue slice of ``limit`` units.
    """
    queue = Q.search_queue(frontier, limit)
    turns = numbered(queue, [F.col("turn").asc(), F.col("state_latest").asc_nulls_first(),
                             F.col("state").asc()], "queue_turn")
    turns = turns.select(F.col("jurisdiction_id").alias("_unit"), F.col("state").alias("_state"),
                         "queue_turn")
    rows = numbered(frontier, [F.col("state").asc(), F.col("jurisdiction_id").asc()])
    # The slice has at most ``limit`` rows.
    return rows.join(F.broadcast(turns), (F.col("jurisdiction_id") == F.col("_unit"))
                     & F.col("state").eqNullSafe(F.col("_state")), "left").drop("_unit", "_state")
