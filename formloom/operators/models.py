"""Places where neural models plug in: batches in, rows out. A model is made once a partition, from a function that is sent along."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import layout, nbest

DETECTION = "page_id string, det_idx int, cls string, x double, y double, w double, h double, score double"
READING = "crop_id string, ftype string, candidates array<string>, logprobs array<double>"


def detected(pages: DataFrame, make: Callable[[], Callable[[object], Iterable[tuple]]]) -> DataFrame:
    """Detections of pages (page_id and whatever the model reads). The model gets a pandas frame and gives rows of DETECTION."""

    def run(batches):
        import pandas as pd

        model = make()
        for pdf in batches:
            yield pd.DataFrame(list(model(pdf)), columns=["page_id", "det_idx", "cls", "x", "y", "w", "h", "score"])

    return pages.mapInPandas(run, DETECTION)


def read(crops: DataFrame, heads: dict[str, Callable[[], Callable[[object], Iterable[tuple[list, list]]]]], types: tuple = ("time", "amount", "text", "date")) -> DataFrame:
    """Candidates of crops (crop_id, ftype, ...), each type by its head. Crops are dealt by type, so that a worker holds few models;
    types without a head give nothing."""

    def run(batches):
        import pandas as pd

        models = {}
        for pdf in batches:
            for kind, own in pdf.groupby("ftype"):
                if kind in heads:
                    if kind not in models:
                        models[kind] = heads[kind]()
                    found = list(models[kind](own))
                    yield pd.DataFrame({"crop_id": own["crop_id"].values, "ftype": kind, "candidates": [c for c, _ in found], "logprobs": [p for _, p in found]})

    salted = crops.where(F.col("ftype").isin(*types)).repartition("ftype", F.pmod(F.xxhash64("crop_id"), F.lit(64)))
    return salted.sortWithinPartitions("ftype").mapInPandas(run, READING)


def stub_detections(fields: DataFrame) -> DataFrame:
    """Detections made of labels (image_id, pos, name, bbox as corners): certain, and of class field. For tests."""
    own = fields.where(F.size("bbox") == 4)
    at = lambda i: F.get("bbox", F.lit(i)).cast("double")
    return own.select(
        F.col("image_id").alias("page_id"), F.col("pos").cast("int").alias("det_idx"), F.lit("field").alias("cls"), at(0).alias("x"), at(1).alias("y"),
        (at(2) - at(0)).alias("w"), (at(3) - at(1)).alias("h"), F.lit(0.999).alias("score"),
    )


#: What a form's classes hold.
CLASS_MAP = {
    "employee_name": "text", "date": "date", "in_am": "time", "out_am": "time", "lunch": "time", "in_pm": "time", "out_pm": "time",
    "total_hours": "amount", "signature": "signature",
}


def typed(cells: DataFrame, class_map: dict[str, str] | None = None, cls: str = "cls") -> DataFrame:
    """Adds ftype: what a detection's class holds, text for unknown ones."""
    own = F.create_map(*(F.lit(x) for kv in (class_map or CLASS_MAP).items() for x in kv))
    return cells.withColumn("ftype", F.coalesce(F.try_element_at(own, F.col(cls)), F.lit("text")))


def routed(crops: DataFrame, heads: dict, keys: list[str], names: list[str]) -> DataFrame:
    """Wide rows of crops (keys, crop_id, cls, col_idx, ftype, signature_present and what the heads read): a signature is present or absent, a type with a
    head has the best of its candidates in sanitized form or else stripped, others are empty. Of several crops of a class the last column's holds."""
    got = None
    for kind in sorted(heads):
        ranked = nbest.ranked(nbest.exploded(read(crops.where(F.col("ftype") == kind), {kind: heads[kind]}, (kind,)), "candidates", "logprobs"), ["crop_id"], kind)
        own = text.typed_or_trimmed(ranked.where("rank = 1").select("crop_id", "cand"), "cand", kind, "_value").select("crop_id", "_value")
        got = own if got is None else got.unionByName(own)
    present = F.when(F.col("ftype") == "signature", F.when(F.col("signature_present"), "present").otherwise("absent"))
    both = crops.select(*keys, "crop_id", "cls", "col_idx", present.alias("_sign"))
    both = both.join(got, "crop_id", "left") if got is not None else both.withColumn("_value", F.lit(None).cast("string"))
    return layout.assembled(both.select(*keys, F.col("cls").alias("name"), "col_idx", F.coalesce("_sign", "_value", F.lit("")).alias("value")), keys, names)
