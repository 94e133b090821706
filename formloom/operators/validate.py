"""Validation of export records, summaries by sheet, and the audit of failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text


def normalized(df: DataFrame, raw: str = "RawText") -> DataFrame:
    """NormalizedTime from the raw text, always anew; parse warnings follow the record's own."""
    own = F.col("Warnings") if "Warnings" in df.columns else F.array().cast("array<string>")
    df = text.time_parsed(df.withColumn("_own", own), raw, "NormalizedTime", "_parse")
    return df.withColumn("Warnings", text.merged(F.col("_own"), F.col("_parse"))).drop("_own", "_parse")


def validated(df: DataFrame, low_conf: float = 0.35) -> DataFrame:
    """Adds IsValid, and warnings of low confidence and missing time."""
    low = F.col("Confidence").try_cast("double") < low_conf
    more = F.array_compact(F.array(F.when(low, f"low_conf<{low_conf}"), F.when(F.col("NormalizedTime").isNull(), "invalid_time")))
    return df.withColumn("Warnings", text.merged(F.col("Warnings"), more)).withColumn("IsValid", F.col("NormalizedTime").isNotNull())


def _mean(values: Column) -> Column:
    """The mean of decimals, 4 digits, ties to even: exact, so it does not depend on the order of rows."""
    return F.bround(F.sum(values.try_cast("decimal(20,8)")) / F.count(values.try_cast("decimal(20,8)")), 4).cast("double")


def summarized(df: DataFrame, key: str = "TimesheetID") -> DataFrame:
    """Records, valid ones, their share and mean confidence by sheet; a null sheet is one. Confidences count to 8 digits."""
    return df.groupBy(key).agg(
        F.count("*").alias("Records"),
        F.sum(F.col("IsValid").cast("long")).alias("ValidRecords"),
        _mean(F.col("IsValid").cast("int")).alias("PctValid"),
        _mean(F.col("Confidence").try_cast("double")).alias("AvgConfidence"),
    )


def in_order(df: DataFrame, *tie: str) -> DataFrame:
    """Sorted by sheet, page, row and column, nulls last; `tie` makes the order total."""
    return df.orderBy(*(F.col(c).asc_nulls_last() for c in ("TimesheetID", "Page", "Row", "Col")), *tie)


def failures(df: DataFrame, low_conf_too: bool = True) -> DataFrame:
    """Records that failed, with Reason (first warning) and CleanText. Warnings may be text split by ';' or an array. Without
    IsValid all count as failed."""
    notes = F.col("Warnings") if dict(df.dtypes)["Warnings"].startswith("array") else text.split_warnings(F.col("Warnings"))
    df = df.withColumn("_notes", notes)
    bad = ~F.coalesce(F.col("IsValid"), F.lit(False)) if "IsValid" in df.columns else F.lit(True)
    if low_conf_too:
        bad = bad | F.exists("_notes", lambda w: F.startswith(w, F.lit("low_conf<")))
    # Generated, so that the filter isn't pushed below the steps that made IsValid and doesn't repeat them.
    df = df.select("*", F.inline(F.array(F.struct(bad.alias("_bad"))))).where("_bad").drop("_bad").withColumn("Reason", F.coalesce(F.try_element_at("_notes", F.lit(1)), F.lit("")))
    return text.time_cleaned(df, "RawText", "CleanText").drop("_notes")


def top_values(df: DataFrame, col: str, n: int) -> DataFrame:
    """The n most frequent values, nulls left out; ties by value."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col).limit(n)


#: Columns of the failure review, in order.
REVIEWED = "TimesheetID Page Row Col FieldKey RawText PrecleanedCandidate NormalizedTime Confidence Reason CropPath _source_file Warnings".split()


def review(failed: DataFrame) -> DataFrame:
    """Failures in the review's columns, those that are there."""
    return present(failed.withColumnRenamed("CleanText", "PrecleanedCandidate"), REVIEWED)


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of the columns that are there, in this order."""
    return df.select([c for c in columns if c in df.columns])
