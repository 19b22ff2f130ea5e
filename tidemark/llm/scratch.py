"""Intermediate tables of one operator in the shared folder, and their removal when it is done."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import checkpoint_root


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Tables written by ``keep`` start the later steps, cost no memory and outlive any executor.

    ``drop`` removes those that nothing reads any more, so disk does not grow with the number of steps.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
        self.tables: list[tuple[DataFrame, str]] = []
        self.made = 0

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made:03d}-{label}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((back, path))
        return back

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            for kept in [x for x in self.tables if x[0] is table]:
                self.tables.remove(kept)
                remove(self.spark, kept[1])
