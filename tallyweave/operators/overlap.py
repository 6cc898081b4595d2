"""Overlap of sources: nearest-progress matching, vector and set similarity, mirrors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.sliced import running_before


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity; null for unequal dimensions or a zero norm (M1)."""
    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                           F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.when((F.size(left) == F.size(right)) & (norms > 0), dot(left, right) / norms)


def vector_violations(df: DataFrame, vector: str, keys: list[str]) -> DataFrame:
    """Vectors a similarity cannot use: empty or of zero norm (M1)."""
    norm = F.aggregate(F.col(vector), F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    return df.filter(F.coalesce(norm, F.lit(0.0)) == 0).select(*keys)


def jaccard(left: Column, right: Column) -> Column:
    """Jaccard similarity of two sets; null when both are empty (M2)."""
    union = F.size(F.array_union(left, right))
    return F.size(F.array_intersect(left, right)) / F.nullif(union, F.lit(0))


PAYLOAD = ["result_vector", "reporting_units", "vote_modes"]


def match_snapshots(left: DataFrame, right: DataFrame, tolerance: float = 0.05,
                    keys: list[str] = ["jurisdiction_id"]) -> DataFrame:
    """Each left snapshot with the right one nearest in progress, within a tolerance.

    Both sides are laid along the reporting fraction; the nearest right snapshot is the last one
    before or the first one after, so no left-right pairs are listed. Equal distances go to the
    earlier capture. Several left snapshots may share a right one.
    """
    f = "reporting_fraction"
    body = F.struct("captured_at", *PAYLOAD)
    # Only ids and fractions are swept; the vectors of chosen pairs are joined afterwards.
    rights = right.filter(F.col(f).isNotNull()).groupBy(*keys, f).agg(
        F.min("captured_at").alias("_tie"))
    near = F.struct(F.col(f).alias("at"), F.col("_tie").alias("t"))
    lefts = left.filter(F.col(f).isNotNull())
    rows = rights.select(*keys, f, F.lit(0).alias("_side"), near.alias("_near")).unionByName(
        lefts.select(*keys, f).distinct().withColumn("_side", F.lit(1)),
        allowMissingColumns=True)
    both = running_before(rows, keys, [f, "_side"], {
        "_lo": ("last", F.col("_near")), "_hi": ("next", F.col("_near"))})
    both = both.filter("_side = 1")
    d_lo, d_hi = F.abs(F.col(f) - F.col("_lo.at")), F.abs(F.col(f) - F.col("_hi.at"))
    lower = F.col("_hi").isNull() | (d_lo < d_hi) | (
        (d_lo == d_hi) & (F.col("_lo.t") <= F.col("_hi.t")))
    chosen = F.when(F.col("_lo").isNotNull() & lower, F.col("_lo")).otherwise(F.col("_hi"))
    pairs = both.withColumn("_c", chosen).filter(
        F.abs(F.col(f) - F.col("_c.at")) <= tolerance).select(
        *keys, f, F.col("_c.at").alias("_right_f"), F.col("_c.t").alias("_right_t"))
    chosen_right = right.groupBy(*keys, F.col(f).alias("_right_f"),
                                 F.col("captured_at").alias("_right_t")).agg(
        F.min(body).alias("_r"))
    out = lefts.select(*keys, f, body.alias("_l")).join(pairs, [*keys, f]).join(
        chosen_right, [*keys, "_right_f", "_right_t"])
    return out.select(
        *keys, F.col("_l.captured_at").alias("left_at"), F.col("_right_t").alias("right_at"),
        F.abs(F.col(f) - F.col("_right_f")).alias("progress_distance"),
        cosine(F.col("_l.result_vector"), F.col("_r.result_vector")).alias("vector_similarity"),
        jaccard(F.col("_l.reporting_units"), F.col("_r.reporting_units"))
        .alias("reporting_unit_jaccard"),
        jaccard(F.col("_l.vote_modes"), F.col("_r.vote_modes")).alias("vote_mode_jaccard"))


def summarize_overlap(pairs: DataFrame, keys: list[str], mirror: float = 0.995,
                      units: float = 0.9) -> DataFrame:
    """Mean similarity and relationship per source pair.

    Dissimilarity never shows independence: that flag is always false.
    """
    out = pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("matched_snapshots"),
        F.avg("vector_similarity").alias("mean_similarity"),
        F.avg("reporting_unit_jaccard").alias("mean_unit_jaccard"),
        F.avg("vote_mode_jaccard").alias("mean_mode_jaccard"))
    u, m = F.col("mean_unit_jaccard"), F.col("mean_mode_jaccard")
    kind = (
        F.when((F.col("mean_similarity") >= mirror) & (u.isNull() | (u >= units)),
               "probable_mirror")
        .when((u > 0) | (m > 0), "partial_overlap")
        .otherwise("uncertain")
    )
    return out.withColumn("relationship", kind).withColumn(
        "residual_independence_established", F.lit(False))
