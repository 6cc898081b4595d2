"""Sinks that may be run again: rows are staged, read back, and put in place by a rename.

What is staged is read back and digested; its folder is named by that digest. The same rows written again
have the same name, so a repeated or retried write leaves one copy, and readers never see half of one.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.operators import observations as O


def _files(spark: SparkSession, folder: str):
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return jvm.Path, fs


def _put(path, fs, folder: str, name: str, text: str) -> None:
    """Write a small file beside its place and rename it there."""
    done, made = path(f"{folder}/{name}"), path(f"{folder}/_{name}-{uuid.uuid4().hex}")
    out = fs.create(made, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(done):
        fs.delete(done, False)
    fs.rename(made, done)


def _load(spark: SparkSession, folder: str, fmt: str, schema: T.StructType) -> DataFrame:
    return spark.read.format(fmt).options(**_options(fmt), pathGlobFilter="part-*").schema(
        schema).load(folder)


def _options(fmt: str) -> dict[str, str]:
    """CSV files carry a header, blanks for nulls, and doubled quotes, as registry files have them."""
    return {"header": "true", "emptyValue": "", "nullValue": "", "escape": '"',
            "multiLine": "true"} if fmt == "csv" else {}


def _stage(df: DataFrame, folder: str, fmt: str) -> str:
    """Write the rows under ``folder`` by the name of their digest, unless they are there; the name."""
    spark = df.sparkSession
    path, fs = _files(spark, folder)
    stage = f"{folder}/_staged-{uuid.uuid4().hex}"
    df.write.format(fmt).options(**_options(fmt)).save(stage)
    digest = O.table_digest(_load(spark, stage, fmt, df.schema)).first()
    name = f"rows={digest['digest']}"
    if fs.exists(path(f"{folder}/{name}")):
        fs.delete(path(stage), True)
    else:
        _put(path, fs, stage, "manifest.json", json.dumps(
            {"format": fmt, "schema": json.loads(df.schema.json()), **digest.asDict()}))
        fs.rename(path(stage), path(f"{folder}/{name}"))
    return name


def replace_rows(df: DataFrame, folder: str, fmt: str = "parquet") -> None:
    """Make ``df`` the rows of a folder: the last write counts."""
    path, fs = _files(df.sparkSession, folder)
    name = _stage(df, folder, fmt)
    _put(path, fs, folder, "current", name)
    for status in fs.listStatus(path(folder)):
        old = status.getPath().getName()
        if old.startswith("rows=") and old != name:
            fs.delete(status.getPath(), True)


def add_rows(df: DataFrame, folder: str, fmt: str = "parquet") -> None:
    """Add a batch of rows to a folder, once however often it is written."""
    _stage(df, folder, fmt)


def committed(spark: SparkSession, folder: str) -> DataFrame | None:
    """The rows of a folder; null before the first write."""
    path, fs = _files(spark, folder)
    if not fs.exists(path(folder)):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(path(folder)))
    chosen = ([row_files(spark, folder).split("/")[-2]] if "current" in names
              else [n for n in names if n.startswith("rows=")])
    if not chosen:
        return None
    first = json.loads(spark.read.text(f"{folder}/{chosen[0]}/manifest.json",
                                       wholetext=True).first()[0])
    rows = [_load(spark, f"{folder}/{n}", first["format"], T.StructType.fromJson(first["schema"]))
            for n in chosen]
    return reduce(DataFrame.unionByName, rows)


def row_files(spark: SparkSession, folder: str) -> str:
    """Where the row files of a folder lie: those of its last replacement, or the folder itself if
    nothing was committed to it."""
    path, fs = _files(spark, folder)
    if not fs.exists(path(f"{folder}/current")):
        return folder
    return f"{folder}/{spark.read.text(f'{folder}/current').first()[0]}/part-*"


def altered(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of a folder whose rows no longer give the digest they are named by."""
    path, fs = _files(spark, folder)
    out = []
    for status in fs.listStatus(path(folder)):
        name = status.getPath().getName()
        if name.startswith("rows="):
            manifest = json.loads(spark.read.text(f"{folder}/{name}/manifest.json",
                                                  wholetext=True).first()[0])
            rows = _load(spark, f"{folder}/{name}", manifest["format"],
                         T.StructType.fromJson(manifest["schema"]))
            if O.table_digest(rows).first()["digest"] != manifest["digest"]:
                out.append((name,))
    return spark.createDataFrame(out, "name string")
