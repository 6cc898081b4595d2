"""Tables kept in the shared folder of the cluster between the jobs of an operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tallyweave.session import checkpoint_dir


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder once and read it from there.

    Unlike a checkpoint it computes the rows once, and what is read does not depend on executors.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
