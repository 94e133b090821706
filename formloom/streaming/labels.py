"""The label log and the export as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import validate


def latest(stream: DataFrame, key: str, pos: str, values: list[str]) -> DataFrame:
    """The last row of each key by position, as a running aggregate (update or complete mode). State: a row a key."""
    return stream.groupBy(key).agg(F.max_by(F.struct(pos, *values), F.col(pos)).alias("_l")).select(key, "_l.*")


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "complete") -> None:
    """Works off all that has come, into parquet; complete results replace those before, each by its batch."""

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(path)

    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()


def exported(stream: DataFrame, low_conf: float = 0.35) -> DataFrame:
    """Export records normalised and validated as they come."""
    return validate.validated(validate.normalized(stream), low_conf)


def by_hour(stream: DataFrame, time: str, kind: str, late: str = "1 hour") -> DataFrame:
    """Counts by hour and kind; rows later than `late` behind the newest are left out and their state is dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, "1 hour").alias("w"), kind).agg(F.count("*").alias("n")).select("w.start", kind, "n")


def parquet_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
