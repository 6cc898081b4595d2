"""Registry files: typed readers and ordered writers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave import schemas
from tallyweave.functions.ids import alias_token
from tallyweave.functions.values import present
from tallyweave.operators import observations as O
from tallyweave.sources.commit import add_rows, replace_rows, row_files

# Authority models whose units are counties.
COUNTY_MODELS = ["county", "county+state", "county+independent-city",
                 "county+board-of-elections", "county+municipal/election-district", "parish",
                 "county+state/local", "state+county", "state+county/local",
                 "local-election-authority"]


def _typed(name: str, kind: T.DataType) -> Column:
    text = present(F.col(f"`{name}`"))
    if isinstance(kind, T.BooleanType):
        return F.coalesce(F.lower(text).isin("1", "true", "yes"), F.lit(False))
    if isinstance(kind, T.DateType):
        return F.when(text.rlike(r"^\d{4}-\d\d-\d\d$"), text.try_cast("date"))
    return text.try_cast(kind)


def read_registry(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header to typed rows (S15): blanks are null, yes/no become booleans.

    A folder that ``write_registry`` wrote gives the rows of its last write. Columns the file lacks are
    null; a byte-order mark before the header is removed.
    """
    raw = spark.read.csv(row_files(spark, path), header=True, inferSchema=False, multiLine=True,
                         escape='"')
    names = {re.sub("^﻿", "", c).strip(): c for c in raw.columns}
    raw = raw.select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()])
    return raw.select(*[
        (_typed(f.name, f.dataType) if f.name in names else F.lit(None).cast(f.dataType))
        .alias(f.name) for f in schema])


def read_localities(spark, path):
    return read_registry(spark, path, schemas.LOCALITY)


def read_denominators(spark, path):
    return read_registry(spark, path, schemas.DENOMINATOR)


def read_source_capabilities(spark, path):
    return read_registry(spark, path, schemas.SOURCE_CAPABILITY)


def read_identity_aliases(spark, path):
    return read_registry(spark, path, schemas.IDENTITY_ALIAS)


def _cells(df: DataFrame) -> DataFrame:
    """Arrays as joined text and nulls as blanks, for one-cell-per-value files."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|")
        out.append(F.coalesce(c.cast("string"), F.lit("")).alias(f.name))
    return df.select(*out)


def write_registry(df: DataFrame, path: str, order: list[Column | str]) -> None:
    """Sorted CSV parts with fixed columns (S18); range partitions keep the order across parts."""
    replace_rows(_cells(df.orderBy(*order)), path, "csv")


def write_identity_aliases(df: DataFrame, path: str) -> None:
    """Aliases in their stable order."""
    columns = [f.name for f in schemas.IDENTITY_ALIAS]
    order = ["object_type", F.lower("alias_namespace"), alias_token(F.col("alias_value")),
             "canonical_id", "alias_kind", "status",
             F.coalesce("effective_from", F.lit("0001-01-01").cast("date")),
             F.coalesce("effective_to", F.lit("9999-12-31").cast("date")), "alias_value"]
    write_registry(df.select(*columns), path, order)


def write_integrity(path: str, *, reconciliation: DataFrame, deltas: DataFrame,
                    facts: DataFrame) -> None:
    """Reconciliation, deltas and a summary row as JSON tables under one folder."""
    replace_rows(reconciliation, f"{path}/reconciliation", "json")
    replace_rows(deltas, f"{path}/deltas", "json")
    summary = facts.agg(F.count(F.lit(1)).alias("observations")).crossJoin(
        reconciliation.agg(F.count(F.lit(1)).alias("reconciliation_rows"),
                           F.count_if(~F.col("reconciles")).alias("unreconciled_rows"))
    ).crossJoin(deltas.agg(F.count(F.lit(1)).alias("deltas")))
    replace_rows(summary, f"{path}/summary", "json")


def write_replay(facts: DataFrame, path: str, columns: list[str]) -> None:
    """Canonical rows beside a digest row."""
    replace_rows(facts, f"{path}/rows")
    replace_rows(O.table_digest(facts, columns), f"{path}/digest", "json")


def append_events(events: DataFrame, path: str) -> None:
    """Append-only event journal (S20); a batch that is written again adds nothing."""
    add_rows(events, path)


def read_gazetteer(spark: SparkSession, path: str, delimiter: str = "\t") -> DataFrame:
    """Delimited gazetteer with trimmed headers and values."""
    raw = spark.read.csv(path, header=True, sep=delimiter, inferSchema=False)
    return raw.select(*[F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c.strip())
                        for c in raw.columns])


def county_starts(gazetteer: DataFrame, localities: DataFrame, denominators: DataFrame,
                  state: str = "USPS", geoid: str = "GEOID", name: str = "NAME") -> DataFrame:
    """County units to add in county-model states, up to the expected number.

    A unit already present by normalized name is not added. Ranking is by geoid; the count of a
    state's units is small by its denominator.
    """
    from pyspark.sql import Window

    def plain(c: Column) -> Column:
        return F.lower(F.trim(F.regexp_replace(
            F.trim(c), r"(?i)\s+(county|parish|borough|census area)$", "")))

    have = localities.select("state", plain(F.col("canonical_name")).alias("_name")).distinct()
    n = localities.groupBy("state").agg(F.count(F.lit(1)).alias("_have"))
    models = denominators.filter(F.trim("authority_model").isin(COUNTY_MODELS)).select(
        "state", "expected_primary_units")
    rows = gazetteer.select(F.col(state).alias("state"), F.col(geoid).alias("external_id"),
                            F.col(name).alias("canonical_name"))
    rows = rows.filter(F.col("external_id").rlike(r"^\d{5}$") & (F.col("canonical_name") != ""))
    rows = rows.join(models, "state").withColumn("_name", plain(F.col("canonical_name")))
    rows = rows.join(have, ["state", "_name"], "left_anti").join(n, "state", "left")
    rows = rows.groupBy("state", "_name", "expected_primary_units", "_have").agg(
        F.min_by("canonical_name", "external_id").alias("canonical_name"),
        F.min("external_id").alias("external_id"))
    w = Window.partitionBy("state").orderBy("external_id")
    room = F.col("expected_primary_units") - F.coalesce("_have", F.lit(0))
    ranked = rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= room)
    return ranked.select(
        F.concat(F.lit("us:"), F.lower("state"), F.lit(":census-county:"), F.col("external_id"))
        .alias("jurisdiction_id"), "state",
        F.when(F.col("state") == "LA", "parish").otherwise("county_equivalent")
        .alias("jurisdiction_level"), "canonical_name", "external_id",
        F.lit("census_geoid").alias("id_status"),
        F.lit("enumerated_unresolved").alias("coverage_status"))
