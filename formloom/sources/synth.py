"""Made-up form crops with known text, the same for any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import labels, layout


#: Boxes above the table.
HEADERS = [("company", 200, 150, 500, 50), ("supervisor", 200, 224, 480, 50), ("date", 1360, 150, 240, 50)]


def crops(spark: SparkSession, n: int, val_ratio: float = 0.1, seed: int = 42, by_page: bool = False, form: layout.Layout = layout.DRAWN) -> DataFrame:
    """n pages of 3 header fields and a field a cell: image, text, field_type, page_image, field_name, bbox_xywh, signature_present (null
    for headers), split. by_page: a page's crops share a split; else each crop is dealt by itself."""
    slots = layout.cells(spark, form).select("row_idx", "col_idx", "name", "ftype", *(F.col(c).cast("int").alias(n) for c, n in (("bx", "x0"), ("by", "y0"), ("bw", "width"), ("bh", "height"))))
    above = [(-1, i, name, "text", x, y, w, h) for i, (name, x, y, w, h) in enumerate(HEADERS)]
    slots = slots.unionByName(spark.createDataFrame(above, "row_idx int, col_idx int, name string, ftype string, x0 int, y0 int, width int, height int"))
    df = spark.range(n).withColumnRenamed("id", "page").crossJoin(F.broadcast(slots))
    draw = lambda salt, m: text.image_number(F.concat_ws("|", F.lit(str(seed)), "page", "row_idx", "col_idx", F.lit(salt))) % m
    first, last = "Ann Ben Cal Dee Eve Fay".split(), "Hill Lake Moor Reed Vale Wood".split()
    pick: dict[str, Column] = {w: F.element_at(F.array(*map(F.lit, words)), (draw(w, len(words)) + 1).cast("int")) for w, words in (("first", first), ("last", last))}
    time = text.from_minutes((draw("hour", 14) + 6) * 60 + draw("quarter", 4) * 15)
    day = F.format_string("%02d/%02d/%d", draw("month", 12) + 1, draw("day", 28) + 1, draw("year", 2) + 2024)
    name = F.col("name")
    value = (
        F.when(name.isin("employee_name", "supervisor"), F.concat_ws(" ", pick["first"], pick["last"]))
        .when(name == "company", F.concat(pick["last"], F.lit(" Works")))
        .when(name == "date", day)
        .when(name == "lunch", text.from_minutes(draw("lunch", 5) * 15))
        .when(name == "signature", F.when(draw("sign", 10) < 8, "present").otherwise("absent"))
        .when(F.col("ftype") == "amount", F.format_string("%.2f", draw("cents", 1200) / 100))
        .otherwise(time)
    )
    df = df.withColumn("text", value).withColumn("signature_present", F.when(F.col("row_idx") >= 0, (name == "signature") & (F.col("text") == "present")))
    df = df.withColumn("field_name", F.when(F.col("row_idx") < 0, name).otherwise(F.concat("name", F.lit("_r"), F.col("row_idx") + 1)))
    page = F.concat(F.lit("pages/page_"), F.col("page"), F.lit(".jpg"))
    df = df.withColumns({"page_image": page, "image": F.concat(F.lit("crops/page_"), F.col("page"), F.lit("_"), F.col("field_name"), F.lit(".jpg"))})
    df = df.withColumn("bbox_xywh", F.array("x0", "y0", "width", "height")).withColumn("_key", F.col("page_image") if by_page else F.col("image"))
    own = labels.split_share(df, "_key", val_ratio, seed)
    return own.select("image", "text", F.col("ftype").alias("field_type"), "page_image", "field_name", "bbox_xywh", "signature_present", "split")
