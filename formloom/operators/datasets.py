"""Training sets for detectors and readers: COCO, YOLO, crops and transcriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from . import labels, layout

#: Classes in the order of their ids. COCO counts from 1 and has no date; YOLO counts from 0.
CLASSES = ["employee_name", "in_am", "out_am", "lunch", "in_pm", "out_pm", "total_hours", "signature", "date"]


def classes(spark, first: int = 0, with_date: bool = True) -> DataFrame:
    own = CLASSES if with_date else CLASSES[:-1]
    return spark.createDataFrame([(i, c) for i, c in enumerate(own, first)], "class_id int, cls string")


def typed(records: DataFrame, dim: DataFrame) -> DataFrame:
    """Records (field_name) of known classes, with cls and class_id. The dimension has a row a class."""
    return records.withColumn("cls", text.field_class(F.col("field_name"))).join(F.broadcast(dim), "cls")


def coco_annotations(records: DataFrame, pos: str = "pos") -> DataFrame:
    """One row an annotation: id counts pages as first met, then records. records: page_image, field_name, x, y, w, h, pos. Ids are
    given by page: a page's first id is the sum of the counts of the pages before it."""
    own = typed(records, classes(records.sparkSession, 1, with_date=False))
    pages = own.groupBy("page_image").agg(F.min(pos).alias("_first"), F.count("*").alias("_n"))
    pages = sums_before(pages, "_first", ["page_image"], "_n", "_before")
    within = F.row_number().over(Window.partitionBy("page_image").orderBy(pos))
    out = own.join(pages.select("page_image", "_before"), "page_image").withColumn("id", (F.col("_before") + within).cast("long"))
    return out.select("id", text.image_number(F.col("page_image")).alias("image_id"), F.col("class_id").alias("category_id"), F.array("x", "y", "w", "h").alias("bbox"), (F.col("w") * F.col("h")).alias("area"), F.lit(0).alias("iscrowd"))


def coco_images(records: DataFrame) -> DataFrame:
    """One row a page that has annotations; sizes are left at 0."""
    own = typed(records, classes(records.sparkSession, 1, with_date=False)).select("page_image").distinct()
    return own.select(text.image_number(F.col("page_image")).alias("id"), F.col("page_image").alias("file_name"), F.lit(0).alias("width"), F.lit(0).alias("height"))


def coco_document(records: DataFrame) -> DataFrame:
    """The whole set as the lines of one JSON document (see sinks.document): images by file name, then annotations by id."""
    from ..sources import sinks

    images = coco_images(records).withColumn("_at", F.col("id"))
    images = images.select("_at", F.to_json(F.struct("id", "file_name", "width", "height")).alias("value"))
    notes = coco_annotations(records).select(F.col("id").alias("_at"), F.to_json(F.struct("id", "image_id", "category_id", "bbox", "area", "iscrowd")).alias("value"))
    kinds = ",".join(f'{{"id":{i},"name":"{c}"}}' for i, c in enumerate(CLASSES[:-1], 1))
    first = sinks.document('{"images":[', images, '],"annotations":[', "_at", ",")
    second = sinks.document("", notes, f'],"categories":[{kinds}]}}', "_at", ",").where("part > 0").withColumn("part", F.col("part") + 2)
    return first.unionByName(second)


def sums_before(df: DataFrame, key: str, ties: list[str], value: str, out: str, share: int = 100_000) -> DataFrame:
    """Adds out: the sum of `value` over all rows before, by key (a number) and ties. Rows are dealt to ranges of about `share` rows; the sums of
    whole ranges are one row each, and no task holds more than a range (or the rows of one key)."""
    ranges = max(1, min(1 << 12, df.count() // share))
    cuts = df.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)] or [0.0], 10_000)).first()[0] or []
    cuts = sorted(set(cuts)) if ranges > 1 else []
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    at = F.lit(0)
    if cuts:
        known = F.from_json(F.lit(str(cuts)), "array<double>")
        at = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda lo, s: F.when((lo + s <= len(cuts)) & (F.get(known, lo + s - 1) <= F.col(key)), lo + s).otherwise(lo))
    df = df.withColumn("_range", at)
    upto = lambda w: F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = df.groupBy("_range").agg(F.sum(value).alias(value)).select("_range", upto(Window.orderBy("_range")).alias("_earlier"))
    own = upto(Window.partitionBy("_range").orderBy(key, *ties))
    return df.withColumn("_own", own).join(F.broadcast(sums), "_range").withColumn(out, F.col("_own") + F.col("_earlier")).drop("_range", "_own", "_earlier")


def yolo_lines(records: DataFrame, with_date: bool = True, pos: str = "pos") -> DataFrame:
    """(page_image, line) of records with page_width and page_height."""
    own = typed(records, classes(records.sparkSession, 0, with_date))
    line = layout.yolo_line(F.col("class_id"), F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.col("page_width"), F.col("page_height"))
    return own.select("page_image", pos, line.alias("line"))


def yolo_pages(lines: DataFrame, pos: str = "pos") -> DataFrame:
    """(page_image, value): the label file of each page."""
    own = F.transform(F.sort_array(F.collect_list(F.struct(pos, "line"))), lambda x: x["line"])
    return lines.groupBy("page_image").agg(F.array_join(own, "\n").alias("value"))


def merged(*inputs: DataFrame) -> DataFrame:
    """All records of several inputs; columns that one lacks are null there."""
    out = inputs[0]
    for other in inputs[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def missing(records: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Records whose file is not there."""
    return records.join(files.select(key).distinct(), key, "left_anti")


def crop_manifest(fields: DataFrame, pad: int = 6, width: int = 1700, height: int = 2200) -> DataFrame:
    """(image_id, field_name, bucket, crop_path, bbox) of fields (image_id, field_name, bbox) with a whole box."""
    own = fields.where(F.size("bbox") == 4)
    box = layout.padded(*(F.get("bbox", F.lit(i)) for i in range(4)), pad, width, height)
    kind = text.bucket(F.col("field_name"))
    path = F.concat_ws("/", "image_id", kind, F.concat("field_name", F.lit(".png")))
    return own.select("image_id", "field_name", kind.alias("bucket"), path.alias("crop_path"), F.array(*box).alias("bbox"))


def imported(lines: DataFrame, boxes: DataFrame, pad: int = 2, width: int = 1700, height: int = 2200) -> DataFrame:
    """Labelled crops: lines (image_id, key, value) joined to boxes (image_id, key, box as JSON); typed by key, null text where the
    value is none. Fields without a box go."""
    both = lines.join(boxes, ["image_id", "key"]).withColumn("bbox", layout.any_box(F.col("box"))).where("bbox is not null")
    both = both.withColumn("ftype", text.field_type(F.col("key")))
    for kind in ("time", "amount"):
        both = labels.typed_label(both, "value", kind, f"_{kind}")
    plain = F.when(labels.usable(F.col("value")), text.strip(F.col("value")))
    value = F.when(F.col("ftype") == "time", F.col("_time")).when(F.col("ftype") == "amount", F.col("_amount")).otherwise(plain)
    box = layout.padded(*(F.get("bbox", F.lit(i)) for i in range(4)), pad, width, height)
    return both.select("image_id", "key", "ftype", value.alias("text"), F.array(*box).alias("bbox"))


def funnel(lines: DataFrame, boxes: DataFrame, files: DataFrame) -> DataFrame:
    """How many lines, lines with an image, fields, fields with a box, and with a usable text there are."""
    own = lines.join(files.select("image_id").distinct().withColumn("_file", F.lit(True)), "image_id", "left")
    own = own.join(boxes.select("image_id", "key", "box"), ["image_id", "key"], "left")
    file, box = F.col("_file").isNotNull(), layout.any_box(F.col("box")).isNotNull()
    return own.agg(
        F.count_distinct("image_id").alias("lines"), F.count_distinct(F.when(file, F.col("image_id"))).alias("img_ok"), F.count("*").alias("fields"),
        F.count_if(file & box).alias("bbox"), F.count_if(file & box & labels.usable(F.col("value"))).alias("text"),
    )


def linted(df: DataFrame, col: str, present: str) -> DataFrame:
    """Adds bad_time and bad_amount: text with a colon is a time, other text an amount; either must be its own sanitized form."""
    df = text.amount(text.time_strict(df, col, "_time"), col, "_amount")
    is_time = F.contains(F.col(col), F.lit(":"))
    same = lambda c: F.col(c).eqNullSafe(F.col(col))
    return df.withColumns({"bad_time": is_time & ~same("_time"), "bad_amount": ~is_time & ~same("_amount"), "missing": ~F.col(present)}).drop("_time", "_amount")


def lint_report(df: DataFrame, by: str) -> DataFrame:
    flags = ("missing", "bad_time", "bad_amount")
    return df.groupBy(by).agg(F.count("*").alias("n"), *(F.count_if(F.col(f)).alias(f) for f in flags))
