"""A table of current rows that streams replace part by part.

Rows are dealt to a fixed number of parts by a hash of their key. A step writes new versions of the parts
that it touches and then a pointer, the list of which version of each part counts, which is put in place
by a rename. A reader follows the newest pointer below its step, so it reads each part once however many steps
there were, and a step that is run again starts from what it started from before. Versions that neither
the current batch nor the one before it points to are deleted.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class CurrentTable:
    def __init__(self, spark: SparkSession, folder: str, keys: list[str], parts: int = 64):
        self.spark, self.folder, self.keys, self.parts = spark, folder, keys, parts
        self.jvm = spark._jvm.org.apache.hadoop.fs
        self.fs = self.jvm.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The parts that hold the keys of ``rows``; at most ``parts`` numbers."""
        return sorted(r[0] for r in rows.select(self.part()).distinct().collect())

    def read(self, below: int | None = None, touched: list[int] | None = None
             ) -> DataFrame | None:
        """The current rows, as they were before a step and of some parts only; null before any."""
        step = self._newest(below)
        if step is None:
            return None
        pointer = self._pointer(step)
        schema = T.StructType.fromJson(pointer["schema"])
        paths = [self._path(version, int(part)) for part, version in pointer["parts"].items()
                 if touched is None or int(part) in touched]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def replace(self, step: int, rows: DataFrame, touched: list[int], since: int) -> None:
        """Make ``rows`` the rows of the touched parts as of ``step``. ``since`` is the first step of
        the batch: what was current before it is kept, so that the batch can run again."""
        before = self._newest(step)
        parts = {} if before is None else {
            p: v for p, v in self._pointer(before)["parts"].items() if int(p) not in touched}
        if touched:
            # Large parts are split over tasks, small ones written by one each.
            dealt = rows.withColumn("_part", self.part()).hint("rebalance", "_part")
            dealt.write.mode("overwrite").partitionBy("_part").parquet(self._path(step))
            for name in self._names(self._path(step)):
                if name.startswith("_part="):
                    parts[name.removeprefix("_part=")] = step
        self._point(step, {"schema": json.loads(rows.schema.json()), "parts": parts})
        self._retire(since)

    def _path(self, version: int, part: int | None = None) -> str:
        path = f"{self.folder}/version={version:018d}"
        return path if part is None else f"{path}/_part={part}"

    def _names(self, folder: str) -> list[str]:
        path = self.jvm.Path(folder)
        if not self.fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path))

    def _steps(self) -> list[int]:
        return [int(n) for n in self._names(f"{self.folder}/pointers") if n.isdigit()]

    def _newest(self, below: int | None) -> int | None:
        return max((s for s in self._steps() if below is None or s < below), default=None)

    def _pointer(self, step: int) -> dict:
        path = f"{self.folder}/pointers/{step:018d}"
        return json.loads(self.spark.read.text(path, wholetext=True).first()[0])

    def _point(self, step: int, pointer: dict) -> None:
        done = self.jvm.Path(f"{self.folder}/pointers/{step:018d}")
        made = self.jvm.Path(f"{self.folder}/pointers/_{step:018d}")
        out = self.fs.create(made, True)
        out.write(bytearray(json.dumps(pointer).encode()))
        out.close()
        if self.fs.exists(done):
            self.fs.delete(done, False)
        self.fs.rename(made, done)

    def _retire(self, since: int) -> None:
        steps = self._steps()
        start = max((s for s in steps if s < since), default=None)
        kept = [s for s in steps if s >= since or s == start]
        used = {(v, p) for s in kept for p, v in self._pointer(s)["parts"].items()}
        for step in set(steps) - set(kept):
            self.fs.delete(self.jvm.Path(f"{self.folder}/pointers/{step:018d}"), False)
        for name in self._names(self.folder):
            if not name.startswith("version="):
                continue
            version = int(name.removeprefix("version="))
            if not any(v == version for v, _ in used):
                self.fs.delete(self.jvm.Path(f"{self.folder}/{name}"), True)
                continue
            for part in self._names(f"{self.folder}/{name}"):
                if part.startswith("_part=") and (version, part.removeprefix("_part=")) not in used:
                    self.fs.delete(self.jvm.Path(f"{self.folder}/{name}/{part}"), True)
