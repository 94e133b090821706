"""Accuracy of predictions against truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text


def tagged(preds: DataFrame, truth: DataFrame, keys: list[str], pred: str, gt: str) -> DataFrame:
    """Predictions left-joined to truth, both normalised, with tag: INVALID_PRED, INVALID_GT, OK or MISMATCH. What has no truth
    gets INVALID_GT."""
    both = preds.join(truth, keys, "left").withColumn("_gt", F.coalesce(gt, F.lit("")))
    both = text.time_lenient(text.time_lenient(both, pred, "pred_time"), "_gt", "gt_time").drop("_gt")
    tag = F.when(F.col("pred_time").isNull(), "INVALID_PRED").when(F.col("gt_time").isNull(), "INVALID_GT")
    return both.withColumn("tag", tag.when(F.col("pred_time") == F.col("gt_time"), "OK").otherwise("MISMATCH"))


def report(tags: DataFrame) -> DataFrame:
    """total, exact, rate and invalid predictions in one row."""
    return tags.agg(
        F.count("*").alias("total"), F.count_if(F.col("tag") == "OK").alias("exact"),
        F.coalesce(F.avg((F.col("tag") == "OK").cast("double")), F.lit(0.0)).alias("rate"),
        F.count_if(F.col("tag") == "INVALID_PRED").alias("invalid_pred"),
    )


def confusion(tags: DataFrame, n: int = 10) -> DataFrame:
    """The most frequent mismatches, ties by truth and prediction. Mismatches are counted, not filtered: a filter would be pushed
    below the normalising steps and repeat them."""
    counts = tags.groupBy("gt_time", "pred_time").agg(F.count_if(F.col("tag") == "MISMATCH").alias("n"))
    return counts.where("n > 0").orderBy(F.desc("n"), "gt_time", "pred_time").limit(n)


def by_column(truth: DataFrame, preds: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Exact matches of wide rows by column (name to kind), and over all (col null). A row without prediction has empty values."""
    for name, kind in columns.items():
        truth, preds = (text.typed_or_trimmed(d, name, kind, name) for d in (truth, preds))
    # Wide rows are joined and then taken apart, so that a row is shuffled once and not once a column.
    wide = truth.select(key, F.struct(*columns).alias("_want")).join(preds.select(key, F.struct(*columns).alias("_got")), key, "left")
    each = (F.struct(F.lit(c).alias("col"), (F.coalesce(F.col(f"_got.{c}"), F.lit("")) == F.col(f"_want.{c}")).cast("long").alias("ok")) for c in columns)
    both = wide.select(F.inline(F.array(*each)))
    sums = both.rollup("col").agg(F.count("*").alias("total"), F.sum("ok").alias("exact"))
    return sums.withColumn("rate", F.col("exact") / F.col("total"))


def columns_of(records: DataFrame, record: str = "record") -> list[str]:
    """Names of the keys that JSON records have, sorted: the columns to evaluate."""
    keys = records.select(F.explode(F.json_object_keys(record)).alias("k")).distinct()
    return [r.k for r in keys.orderBy("k").collect()]


def match_and_cer(df: DataFrame, pred: str, ref: str, keys: list[str]) -> DataFrame:
    """Exact match and character error rate (all edits over all reference characters)."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        (F.sum((F.col(pred) == F.col(ref)).cast("long")) / F.greatest(F.count("*"), F.lit(1))).alias("em"),
        F.try_divide(F.sum(F.levenshtein(pred, ref)), F.sum(F.length(ref))).alias("cer"),
    )


def best_so_far(df: DataFrame, epoch: str, value: str) -> DataFrame:
    """Adds is_best: strictly above all earlier epochs (and -1). One row an epoch goes through one task."""
    from pyspark.sql import Window

    before = F.max(value).over(Window.orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("is_best", F.col(value) > F.coalesce(before, F.lit(-1.0)))
