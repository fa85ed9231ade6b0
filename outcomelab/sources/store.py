"""A result store with idempotent commits.

Results are committed under named keys, such as (run, label).  A commit writes
its rows into a folder of its own and last a marker row that names the keys
and that folder.  Readers look at the markers only: the latest commit of a
key is its content, whatever an earlier, a repeated or a half-written one
left behind.  So writing a key twice replaces it, a writer may die at any
point, and writers of different keys run side by side.

Folders are named by the commit, never by a key's value, so values may hold
any character.  The markers are one row per commit; the rows of a result are
never collected.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ResultStore:
    def __init__(self, spark: SparkSession, root: str, keys: list[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self._marker = ", ".join(f"`{k}` string" for k in self.keys) + ", seq long, rows long, folder string"

    def commit(self, rows: DataFrame, **values: str) -> str:
        """Make ``rows`` the content of the key; returns the commit's name."""
        if sorted(values) != sorted(self.keys):
            raise ValueError(f"keys {sorted(values)} instead of {sorted(self.keys)}")
        folder = f"c{uuid.uuid4().hex}"
        path = f"{self.root}/rows/{folder}"
        rows.write.parquet(path)
        n = self.spark.read.parquet(path).count()
        marker = self.spark.range(1, numPartitions=1).select(
            *[F.lit(str(values[k])).alias(k) for k in self.keys], F.lit(time.time_ns()).alias("seq"),
            F.lit(n).cast("long").alias("rows"), F.lit(folder).alias("folder"))
        # a marker's file appears when its write is committed, in a folder no other writer uses
        marker.write.parquet(f"{self.root}/commits/marker={folder}")
        return folder

    def history(self) -> DataFrame:
        """Every commit ever made: the keys, seq, rows, folder."""
        try:
            every = self.spark.read.schema(self._marker).parquet(f"{self.root}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            every = self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                                 for f in T.StructType.fromDDL(self._marker).fields])
        return every.select(*self.keys, "seq", "rows", "folder")

    def commits(self) -> DataFrame:
        """The latest commit of every key: the keys, seq, rows, folder."""
        newest = W.partitionBy(*self.keys).orderBy(F.desc("seq"), F.desc("folder"))   # the commits of one key
        return self.history().withColumn("n", F.row_number().over(newest)).where("n = 1").drop("n")

    def contains(self, **values: str) -> bool:
        return bool(self._committed(values).limit(1).collect())

    def _committed(self, values: dict[str, str]) -> DataFrame:
        found = self.commits()
        for k, v in values.items():
            found = found.where(F.col(k) == str(v))
        return found

    def read(self, **values: str) -> DataFrame | None:
        """The committed rows, with the key columns, of all keys that have
        the given values; None where nothing is committed.  Only the folders
        of these commits are read."""
        marks = self._committed(values)
        found = marks.select("folder").collect()   # one row per key
        if not found:
            return None
        rows = self.spark.read.option("basePath", f"{self.root}/rows").parquet(
            *[f"{self.root}/rows/{r['folder']}" for r in found])
        rows = rows.withColumn("folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
        return rows.join(F.broadcast(marks.drop("seq", "rows")), "folder").drop("folder")
