"""Tables that a keyed write changes in part: dealt into buckets by a column that all keys hold, a folder each, of which a merge reads the touched
and writes the changed.

A change's bucket follows from its key, so only the folders that changes fall into are read (the scan is pruned to them) and joined; of these only the ones in
which a row has become another, or a new one, are written, each by replacing its folder. Other files keep their names and their bytes. Merges are
functions of foliary.operators.merge with `flag`, which marks the rows that differ; being upserts they can be repeated, so a merge that broke off
while folders were replaced is simply run again. One writer at a time: the ledger's runs see to that.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary.sources import shared

FLAG = "__changed"


@dataclass(frozen=True)
class KeyedTable:
    """A table at path in so many buckets by the column `by`. Choose the buckets once, for files of some hundred MB."""

    spark: SparkSession
    path: str
    schema: T.StructType
    by: str = "rc_rfile_no"
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{self.by}`")), F.lit(self.buckets)).cast("int").alias("__bucket")

    def _write(self, rows: DataFrame, mode: str) -> None:
        rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("__bucket").parquet(self.path)

    def create(self, rows: DataFrame) -> KeyedTable:
        dealt = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema], self._bucket())
        self._write(dealt.repartition("__bucket"), "errorifexists")
        return self

    def _all(self) -> DataFrame:
        return self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("__bucket", T.IntegerType())])).parquet(self.path)

    def read(self) -> DataFrame:
        return self._all().drop("__bucket")

    def merge(self, changes: DataFrame, how: Callable[..., DataFrame]) -> list[int]:
        """how(table, changes, flag=...) gives the touched buckets after the changes; returns the buckets that were written. Changes are written first, so
        whatever makes them is asked once."""
        work = shared.scratch(self.spark)
        dealt = changes.withColumn("__bucket", self._bucket())
        dealt.write.partitionBy("__bucket").parquet(f"{work}/changes")
        if not shared.complete(self.spark, f"{work}/changes"):
            raise OSError("the changes aren't there")
        given = self.spark.read.schema(T.StructType([*changes.schema.fields, T.StructField("__bucket", T.IntegerType())])).parquet(f"{work}/changes")
        touched = sorted(r[0] for r in given.select("__bucket").distinct().collect())  # `buckets` numbers at most
        if not touched:
            shared.remove(self.spark, work)
            return []
        old = self._all().where(F.col("__bucket").isin(touched)).drop("__bucket")
        after = how(old, given.drop("__bucket"), flag=FLAG)
        after.withColumn("__bucket", self._bucket()).write.partitionBy("__bucket").parquet(f"{work}/after")
        staged = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(FLAG, T.BooleanType()), T.StructField("__bucket", T.IntegerType())])).parquet(f"{work}/after")
        changed = sorted(r[0] for r in staged.where(FLAG).select("__bucket").distinct().collect())
        if changed:
            self._write(staged.where(F.col("__bucket").isin(changed)).drop(FLAG).repartition("__bucket"), "overwrite")
        shared.remove(self.spark, work)
        return changed
