"""Two payloads of one count held against each other (P5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.operators import observations as O
from tallyweave.session import write_once
from tallyweave.sources import intake as I
from tallyweave.sources import results as R


def district_captures(captures: DataFrame, body: str, key: str) -> tuple[DataFrame, DataFrame]:
    """District files with a header each (S11): their rows and violations, by ``key``."""
    rows = I.csv_rows(captures, body, {key: F.col(key)})
    names = [*R.DISTRICT_KEY, "County Name", *R.DISTRICTS]
    raw = rows.select(key, *[I._value(n.lower()).alias(n) for n in names])
    return R.district_csv(write_once(raw), [key])  # files are parsed once


def payload_crosscheck(tables: DataFrame, districts: DataFrame, key: str, contest: str,
                       table_party: str, district_party: str, body: str = "body",
                       statewide: str = "00") -> DataFrame:
    """Candidate totals of a table page against the district sums of a file, one row per ``key``.

    Only the rows of the whole state count; counties are never added to them. ``status`` is
    ``crosschecked``, or the first of ``duplicate_candidate``, ``candidate_context_mismatch`` and
    ``totals_disagree`` that holds; matched candidates and votes are those on which both agree.
    """
    page, _ = R.statewide_tables(tables, [key], body)
    page = page.filter(F.col("party") == table_party).select(
        key, "candidate", F.col("total").alias("votes"))
    rows, _ = district_captures(districts, body, key)
    file = rows.filter((F.col("county_code") == statewide) & (F.col("contest") == contest)
                       & (F.col("party") == district_party)).select(
        key, "candidate", F.col("district_sum").alias("votes"))
    twice = page.unionByName(file).select(key).limit(0)
    for side in (page, file):
        twice = twice.unionByName(O.duplicate_keys(side, [key, "candidate"]).select(key))
    twice = twice.distinct().withColumn("_twice", F.lit(True))
    both = O.total_crosscheck(file, page, ["candidate"], scope=[key])
    keys = tables.select(key).unionByName(districts.select(key)).distinct()
    out = keys.join(both, key, "left").join(twice, key, "left")
    other = F.coalesce(F.col("only_left") + F.col("only_right"), F.lit(1)) > 0
    status = (F.when(F.col("_twice"), "duplicate_candidate")
              .when(other, "candidate_context_mismatch")
              .when(F.col("different") > 0, "totals_disagree").otherwise("crosschecked"))
    return out.select(key, status.alias("status"),
                      *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                        for c in ("matched_keys", "matched_votes")])
