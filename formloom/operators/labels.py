"""The append-only label log: latest wins; and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

#: Marks that stand for no text.
SENTINELS = ("", "<EMPTY>", "<ILLEGIBLE>", "<SIGNATURE>", "NA", "N/A")


def latest(log: DataFrame, key: str, pos: str, label: str | None = None) -> DataFrame:
    """The last row of each key by position. label: rows with a blank key or label are left out first. The aggregate combines
    before its shuffle, so a key with very many rows is no burden."""
    if label:
        log = log.where((F.trim(F.coalesce(key, F.lit(""))) != "") & (F.trim(F.coalesce(label, F.lit(""))) != ""))
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(pos)).alias("_last")).select(key, "_last.*")


def usable(value: Column) -> Column:
    return ~F.coalesce(F.trim(value), F.lit("")).isin(*SENTINELS)


def typed_label(df: DataFrame, col: str, kind: str, out: str) -> DataFrame:
    """The sanitized value where there is a label and it is valid, else null."""
    df = df.withColumn(f"__{out}", F.when(usable(F.col(col)), text.strip(F.col(col))))
    df = text.SANITIZERS[kind](df, f"__{out}", out) if kind in text.SANITIZERS else df.withColumn(out, F.col(f"__{out}"))
    return df.drop(f"__{out}")


def gold(log: DataFrame, key: str, pos: str, label: str, kind: str) -> DataFrame:
    """(key, text): latest labels, times sanitized where they can be."""
    last = latest(log, key, pos, label)
    if kind == "time":
        last = text.time_strict(last, label, "_t").withColumn(label, F.coalesce("_t", label)).drop("_t")
    return last.select(key, F.col(label).alias("text"))


def split_exact(df: DataFrame, key: str, val_ratio: float = 0.1, seed: int = 13) -> DataFrame:
    """Adds split: max(1, int(ratio * n)) rows of smallest hash are val. The limit is found by a top-n query, and no
    window spans all rows."""
    df = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))))
    n = max(1, int(val_ratio * df.count()))
    if n <= 100_000:
        last = df.select("_h").orderBy("_h").limit(n).agg(F.max("_h").alias("_edge"))
    else:  # the edge is the n-th hash: counted by prefix first, so that only one prefix is sorted
        by = df.groupBy(F.substring("_h", 1, 4).alias("p")).count().orderBy("p").collect()
        left, prefix = n, ""
        for p, c in by:
            prefix = p
            if left <= c:
                break
            left -= c
        last = df.where(F.substring("_h", 1, 4) == prefix).select("_h").orderBy("_h").limit(left).agg(F.max("_h").alias("_edge"))
    return df.crossJoin(F.broadcast(last)).withColumn("split", F.when(F.col("_h") <= F.col("_edge"), "val").otherwise("train")).drop("_h", "_edge")


def split_share(df: DataFrame, key: str, val_ratio: float = 0.1, seed: int = 13) -> DataFrame:
    """Adds split by a hash of the key alone: rows of one key (a page, say) stay together."""
    draw = text.image_number(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))) % 1_000_000
    return df.withColumn("split", F.when(draw < int(val_ratio * 1_000_000), "val").otherwise("train"))
