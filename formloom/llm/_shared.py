"""Helpers of this subpackage: tables in the shared folder, and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share. One is made up only where none is set and all runs on one machine (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="formloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """Tables written once and read again: they cut lineage and survive lost executors. They are deleted when the driver ends, for results
    that were not yet worked out read them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        root = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(root)
        fs.deleteOnExit(root)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of `edges` (a, b: long). Returns (node, root): every node that has an edge
    with the smallest node of its component. Alternates large-star and small-star steps; each step is two
    keyed aggregations whose result is a table in the shared folder, so nothing grows with the diameter.
    """
    star = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    star, step, last = scratch.save(star, "star0"), 0, None
    while True:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        step += 1
        star = scratch.save(small, f"star{step}")
        scratch.drop(f"star{step - 1}")
        now = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == last:
            return star.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = now


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
