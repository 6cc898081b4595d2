"""Running values over long ordered groups without putting a whole group in one task.

A window partitioned by a hot key sends every row of that key to one task. Here the rows are
range-partitioned by key and order, so a hot key spreads over as many parts as it needs. The
window runs inside ``(part, key)``; a key that crosses parts carries one row of values from each
to the next. No slice width has to be guessed, and equal order values are split like any others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.session import write_once

# Kind: does it look at later rows, how one row enters, and how a carried value is merged in.
_AGGREGATE = {
    "last": lambda v: F.last(v, ignorenulls=True),
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
}
_MERGE = {
    "last": lambda local, carried: F.coalesce(local, carried),
    "max": lambda local, carried: F.greatest(local, carried),
    "min": lambda local, carried: F.least(local, carried),
    "sum": lambda local, carried: F.coalesce(local, F.lit(0)) + F.coalesce(carried, F.lit(0)),
}
_LATER = {"next": "last", "max_after": "max"}


def _same(left: Column, right: Column, keys: list[str]) -> Column:
    """Equality over keys in which null equals null."""
    return reduce(lambda a, k: a & left(k).eqNullSafe(right(k)), keys, F.lit(True))


def running_before(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Add, per row, running values over the other rows of its key.

    ``values`` maps an output name to ``(kind, expression)``. Kinds ``last`` (last non-null),
    ``max``, ``min`` and ``sum`` see the strictly earlier rows, ``next`` (nearest non-null) and
    ``max_after`` the strictly later ones. Rows equal in ``order`` follow each other by a hash of
    their columns. Null keys form one group and null order values come first.

    The laid-out rows are written once: two shuffles of the rows, one of the totals per part and
    key. Only keys that cross parts carry values, at most two per part, so that side is broadcast.
    """
    base = df.select("*", *[expr.alias(f"_v_{n}") for n, (_, expr) in values.items()])
    hashable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    base = base.withColumn("_tie", F.xxhash64(*hashable))
    place = [*order, "_tie"]
    laid = base.repartitionByRange(*keys, *place).withColumn("_part", F.spark_partition_id())

    def windows(partition: list[str], by: list[str]):
        w = Window.partitionBy(*partition)
        ahead = w.orderBy(*[F.col(c).asc() for c in by])
        back = w.orderBy(*[F.col(c).desc() for c in by])
        return [x.rowsBetween(Window.unboundedPreceding, -1) for x in (ahead, back)]

    inner, outer = windows(["_part", *keys], place), windows(["_part_key"], ["_part"])
    local, totals, carried = [], [], []
    for name, (kind, _) in values.items():
        later = kind in _LATER
        aggregate = _AGGREGATE[_LATER.get(kind, kind)]
        local.append(aggregate(F.col(f"_v_{name}")).over(inner[later]).alias(f"_l_{name}"))
        if kind in ("last", "next"):
            seen = F.when(F.col(f"_v_{name}").isNotNull(), F.struct(*place))
            pick = F.min_by if later else F.max_by
            totals.append(pick(f"_v_{name}", seen).alias(f"_t_{name}"))
        else:
            totals.append(aggregate(F.col(f"_v_{name}")).alias(f"_t_{name}"))
        carried.append(aggregate(F.col(f"_t_{name}")).over(outer[later]).alias(f"_c_{name}"))

    rows = write_once(laid.select("*", *local))
    parts = rows.groupBy("_part", *keys).agg(*totals)
    parts = parts.withColumn("_part_key", F.struct(*keys))
    crossing = F.count(F.lit(1)).over(Window.partitionBy("_part_key"))
    edges = parts.select("*", crossing.alias("_parts"), *carried).filter("_parts > 1").select(
        F.col("_part").alias("_k__part"), *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[f"_c_{name}" for name in values])
    cond = _same(lambda k: rows[k], lambda k: edges[f"_k_{k}"], keys)
    joined = rows.join(F.broadcast(edges), (rows["_part"] == edges["_k__part"]) & cond, "left")
    out = [rows[c] for c in df.columns]
    for name, (kind, _) in values.items():
        merge = _MERGE[_LATER.get(kind, kind)]
        out.append(merge(F.col(f"_l_{name}"), F.col(f"_c_{name}")).alias(name))
    return joined.select(*out)


def count_since_last(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    is_reset: Column,
    is_counted: Column,
    name: str = "count_since",
) -> DataFrame:
    """Per key, how many counted rows come after the last reset row (one row per key).

    Two map-side combined aggregates and one join; no window over the key.
    """
    rows = df.select(*keys, F.struct(*order).alias("_at"), is_reset.alias("_reset"),
                     is_counted.alias("_counted"))
    last = rows.groupBy(*keys).agg(F.max(F.when(F.col("_reset"), F.col("_at"))).alias("_last"))
    last = last.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_last")
    cond = F.lit(True)
    for key in keys:
        cond = cond & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    after = F.col("_last").isNull() | (F.col("_at") > F.col("_last"))
    return (
        rows.join(last, cond, "left")
        .groupBy(*keys)
        .agg(F.count_if(F.col("_counted") & after).alias(name))
    )
