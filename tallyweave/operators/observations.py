"""Facts: diff, change counts, double-count guard, reconciliation, digest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIFF_KEY = ["reporting_unit_id", "contest_name", "choice_name", "vote_mode"]
CAPTURE_KEY = ["reporting_unit_id", "contest_name", "choice_name", "party", "vote_mode",
               "raw_vote_mode"]
TOTAL_MODE = "total"
NON_COMPONENT_MODES = ["total", "unknown", "other"]


def last_wins(df: DataFrame, keys: list[str], value: str, order: list[str] | None) -> DataFrame:
    """One value per key; the highest ``order`` wins. Combines map-side."""
    rank = F.struct(*order) if order else F.col(value)
    return df.groupBy(*keys).agg(F.max_by(value, rank).alias(value))


def both_sides(previous: DataFrame, current: DataFrame, keys: list[str], value: str = "votes",
               order: list[str] | None = None) -> DataFrame:
    """Full outer pairing on null-safe keys as one union and one aggregate.

    A grouped union needs one shuffle, combines map-side and treats null keys as equal, so a
    hot key costs one row per task and side. Returns keys, old, new, in_old, in_new.
    """
    def side(df: DataFrame, is_new: bool) -> DataFrame:
        rank = F.struct(*order) if order else F.struct(F.col(value))
        return df.select(*keys, F.col(value).alias("_v"), rank.alias("_rank"),
                         F.lit(is_new).alias("_new"))

    new = F.col("_new")
    return (
        side(previous, False).unionByName(side(current, True))
        .groupBy(*keys)
        .agg(
            F.max_by("_v", F.when(~new, F.col("_rank"))).alias("old"),
            F.max_by("_v", F.when(new, F.col("_rank"))).alias("new"),
            F.bool_or(~new).alias("in_old"),
            F.bool_or(new).alias("in_new"),
        )
    )


def snapshot_diff(previous: DataFrame, current: DataFrame, keys: list[str] = DIFF_KEY,
                  order: list[str] | None = None) -> DataFrame:
    """New or changed rows of ``current``; rows that vanished are not reported.

    Every current row is compared, so duplicates in ``current`` each give a delta, while the
    last previous row of a key is its old value.
    """
    old = last_wins(previous, keys, "votes", order).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("votes").alias("old_votes"))
    cond = reduce(lambda a, k: a & F.col(k).eqNullSafe(F.col(f"_k_{k}")), keys, F.lit(True))
    return (
        current.select(*keys, F.col("votes").alias("new_votes"))
        .join(old, cond, "left")
        .filter(~F.col("old_votes").eqNullSafe(F.col("new_votes")))
        .select(*keys, "old_votes", "new_votes",
                (F.col("new_votes") - F.coalesce("old_votes", F.lit(0))).alias("delta"))
    )


def change_summary(previous: DataFrame, current: DataFrame, *, cumulative: bool,
                   keys: list[str] = CAPTURE_KEY, scope: list[str] | None = None,
                   order: list[str] | None = None) -> DataFrame:
    """Counts of added, removed, changed, decreased and common keys.

    ``decreased_rows`` is counted only for cumulative feeds. ``scope`` columns, which must be
    part of the rows on both sides, give one summary row per scope.
    """
    scope = scope or []
    pairs = both_sides(previous, current, scope + keys, order=order)
    common = F.col("in_old") & F.col("in_new")
    decreased = common & (F.col("new") < F.col("old")) & F.lit(cumulative)
    return pairs.groupBy(*scope).agg(
        F.count_if(~F.col("in_old")).alias("added_rows"),
        F.count_if(~F.col("in_new")).alias("removed_rows"),
        F.count_if(common & (F.col("old") != F.col("new"))).alias("changed_rows"),
        F.count_if(decreased).alias("decreased_rows"),
        F.count_if(common).alias("common_rows"),
    )


def capture_warnings(summary: DataFrame, has_baseline: Column | None = None) -> DataFrame:
    """Review reasons of a change summary: rows gone, votes lowered, no shared identity."""
    baseline = has_baseline if has_baseline is not None else (
        (F.col("removed_rows") + F.col("common_rows")) > 0)
    reasons = F.array_compact(F.array(
        F.when(F.col("removed_rows") > 0, F.lit("rows_disappeared")),
        F.when(F.col("decreased_rows") > 0, F.lit("cumulative_votes_decreased")),
        F.when(baseline & (F.col("common_rows") == 0), F.lit("identity_discontinuity")),
    ))
    return summary.withColumn("warnings", reasons).withColumn(
        "status", F.when(F.size("warnings") > 0, F.lit("review_required")).otherwise(F.lit("ok")))


def guard_key(df: DataFrame) -> list[Column]:
    """The seven grouping expressions of the double-count guard, using columns that exist."""
    def pick(name: str, *options: str) -> Column:
        found = [F.col(o).cast("string") for o in options if o in df.columns]
        # Blank ids and hashes fall through to the next option.
        tests = [F.when(c != "", c) for c in found]
        return (F.coalesce(*tests) if tests else F.lit(None).cast("string")).alias(name)

    return [
        pick("election_id", "election_id"),
        pick("jurisdiction_id", "jurisdiction_id"),
        pick("source_id", "source_id"),
        pick("capture", "snapshot_sha256", "fetched_at"),
        pick("reporting_unit_id", "reporting_unit_id"),
        pick("contest", "contest_id", "contest_name"),
        pick("choice", "choice_id", "choice_name"),
    ]


def double_count_violations(obs: DataFrame) -> DataFrame:
    """Groups where a total sits beside a real component mode (A2)."""
    mode = F.col("vote_mode")
    return (
        obs.groupBy(*guard_key(obs))
        .agg(
            F.bool_or(mode == TOTAL_MODE).alias("has_total"),
            F.bool_or(~mode.isin(NON_COMPONENT_MODES)).alias("has_component"),
        )
        .filter("has_total and has_component")
        .drop("has_total", "has_component")
    )


def aggregate_observations(obs: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Votes by contest, choice and mode, optionally within scope columns (A1)."""
    keys = (scope or []) + ["contest_name", "choice_name", "vote_mode"]
    return obs.groupBy(*keys).agg(F.sum("votes").alias("votes"))


def reconcile_to_summary(detail: DataFrame, summary: DataFrame,
                         scope: list[str] | None = None) -> DataFrame:
    """Detail sums against published summary totals, driven by the summary side."""
    keys = (scope or []) + ["contest_name", "choice_name", "vote_mode"]
    d = aggregate_observations(detail, scope).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("votes").alias("_detail"))
    s = aggregate_observations(summary, scope).withColumnRenamed("votes", "summary_total")
    cond = reduce(lambda a, k: a & F.col(k).eqNullSafe(F.col(f"_k_{k}")), keys, F.lit(True))
    out = s.join(d, cond, "left").select(
        *keys, F.coalesce("_detail", F.lit(0)).alias("precinct_sum"), "summary_total")
    residual = F.col("precinct_sum") - F.col("summary_total")
    return out.withColumn("residual", residual).withColumn("reconciles", residual == 0)


def total_crosscheck(left: DataFrame, right: DataFrame, keys: list[str],
                     value: str = "votes", scope: list[str] | None = None) -> DataFrame:
    """Two independent totals must have equal key sets and equal values."""
    scope = scope or []
    pairs = both_sides(left, right, scope + keys, value=value)
    same = F.col("in_old") & F.col("in_new") & F.col("old").eqNullSafe(F.col("new"))
    return pairs.groupBy(*scope).agg(
        F.count_if(same).alias("matched_keys"),
        F.coalesce(F.sum(F.when(same, F.col("new"))), F.lit(0)).alias("matched_votes"),
        F.count_if(~F.col("in_old")).alias("only_right"),
        F.count_if(~F.col("in_new")).alias("only_left"),
        F.count_if(F.col("in_old") & F.col("in_new") & ~F.col("old").eqNullSafe(F.col("new")))
        .alias("different"),
        F.bool_and(same).alias("crosschecked"),
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with the count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def row_hash(columns: list[str]) -> Column:
    """SHA-256 of the row as ``name=value`` lines in column-name order; null differs from ''."""
    parts = []
    for name in sorted(columns):
        text = F.col(name).cast("string")
        parts.append(F.concat(F.lit(name + "="), F.coalesce(
            F.concat(F.lit("'"), text, F.lit("'")), F.lit("null"))))
    return F.sha2(F.concat_ws("\n", *parts), 256)


def table_digest(df: DataFrame, columns: list[str] | None = None,
                 scope: list[str] | None = None) -> DataFrame:
    """Order-independent digest of a table, or one per scope value.

    Row hashes are added up as eight 32-bit lanes, so partial sums combine map-side and no task
    ever holds the list of hashes. Duplicate rows change the sums. The digest hashes the row
    count and the eight sums.
    """
    columns = columns or df.columns
    scope = scope or []
    hashed = df.select(*scope, row_hash(columns).alias("_h"))
    sums = []
    for lane in range(8):
        piece = F.conv(F.substring("_h", 1 + 8 * lane, 8), 16, 10).cast("decimal(20,0)")
        sums.append(F.coalesce(F.sum(piece), F.lit(0)).cast("decimal(38,0)").alias(f"_s{lane}"))
    agg = hashed.groupBy(*scope).agg(F.count(F.lit(1)).alias("row_count"), *sums)
    text = F.concat_ws("|", F.col("row_count").cast("string"),
                       *[F.col(f"_s{i}").cast("string") for i in range(8)])
    return agg.select(*scope, "row_count", F.sha2(text, 256).alias("digest"))


def same_content(left: DataFrame, right: DataFrame) -> bool:
    """Replay equality: both tables hold the same multiset of rows."""
    columns = sorted(left.columns)
    if columns != sorted(right.columns):
        return False
    rows = [table_digest(df.select(*columns)).first() for df in (left, right)]
    return rows[0].digest == rows[1].digest


def multilevel_reconcile(obs: DataFrame, levels: list[str],
                         keys: list[str] = ["contest_name", "choice_name"]) -> DataFrame:
    """Compare totals published at each level with the sum of the level just below.

    ``obs`` carries ``level`` (one of ``levels``, finest first), ``level_key``, ``parent_key``
    and ``votes``. One row per upper-level key.
    """
    order = F.create_map(*[x for i, l in enumerate(levels) for x in (F.lit(l), F.lit(i))])
    ranked = obs.withColumn("_rank", order[F.col("level")])
    lower = (
        ranked.filter(F.col("_rank") < len(levels) - 1)
        .groupBy((F.col("_rank") + 1).alias("_rank"), F.col("parent_key").alias("level_key"),
                 *keys)
        .agg(F.sum("votes").alias("lower_sum"))
    )
    upper = (
        ranked.filter(F.col("_rank") > 0)
        .groupBy("_rank", "level", "level_key", *keys)
        .agg(F.sum("votes").alias("published"))
    )
    return (
        upper.join(lower, ["_rank", "level_key", *keys], "left")
        .select("level", "level_key", *keys, F.coalesce("lower_sum", F.lit(0)).alias("lower_sum"),
                "published",
                (F.coalesce("lower_sum", F.lit(0)) - F.col("published")).alias("residual"))
    )
