"""Session settings, checkpointing and plan helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the next aggregate then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Text parsing costs far more per byte than a scan: keep small shuffles on all cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # HotSpot does not compile larger methods; past it, generate code per operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; partition counts stay the cluster's."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    # Python workers must find this package when it is run from a source folder; on a cluster it
    # is shipped with --py-files as usual.
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    root = str(Path(__file__).resolve().parents[1])
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(
            [p for p in paths if p] + [root])
    return spark


def local_session(cores: int | str = "*", app: str = "tallyweave", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; only a local session may make its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="spark-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so an iterative plan survives the loss of executors."""
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def write_once(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    Its rows are computed once however often they are used, later plans start at the table, and
    values such as partition numbers stay as they are when executors are lost.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bind(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns that are computed once per row and then only referred to.

    A one-element ``inline`` keeps the optimizer from copying a long expression into every
    filter and projection above it; it adds no rows and no shuffle.
    """
    row = F.struct(*[expr.alias(name) for name, expr in values.items()])
    return df.select("*", F.inline(F.array(row)))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once and only referred to, inside an expression.

    A tree that holds a long part many times grows with the product; plans, the code sent to
    tasks and the work of a row grow with it.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fixed_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small constant table as literals in the plan (its size is the length of ``rows``)."""
    names = [part.strip().split(" ", 1) for part in schema.split(",")]
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, names)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
