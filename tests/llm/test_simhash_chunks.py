from pyspark.sql import functions as F

from formloom.llm import simhash
from formloom.llm._shared import Scratch


def test_equal_fingerprints_are_dealt_over_chunks(spark):
    entries = spark.range(400).select(F.lit(1).cast("long").alias("shard"), F.lit(5).cast("long").alias("fp"), F.col("id").alias("node"))
    own = simhash.chunked(entries, Scratch(spark, "chunks"), 64).select("node", "own").distinct().groupBy("own").count().collect()
    assert sum(r["count"] for r in own) == 400 and max(r["count"] for r in own) <= 64
