"""Writing: CSV, JSON lines, label files and the review page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .records import LOG


def csv_form(df: DataFrame, run_id: str) -> DataFrame:
    """RunID first, warnings joined, truth values as True and False."""
    kinds = dict(df.dtypes)
    shown = {c: F.array_join(c, "; ") for c, t in kinds.items() if t == "array<string>"}
    shown |= {c: F.initcap(F.col(c).cast("string")) for c, t in kinds.items() if t == "boolean"}
    return df.select(F.lit(run_id).alias("RunID"), *(shown.get(c, F.col(c)).alias(c) for c in df.columns))


def write_export(detail: DataFrame, summary: DataFrame, path: str, run_id: str) -> None:
    for name, df in (("detail", detail), ("summary", summary)):
        csv_form(df, run_id).write.mode("overwrite").csv(f"{path}/{name}", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_jsonl(df: DataFrame, path: str, order: str | None = None) -> None:
    (df.orderBy(order) if order else df).write.mode("overwrite").json(path)


def write_splits(df: DataFrame, path: str) -> None:
    """One folder of JSON lines a split."""
    df.write.mode("overwrite").partitionBy("split").json(path)


def write_pages(pages: DataFrame, path: str, key: str = "page_image") -> DataFrame:
    """One label file a page, named after its image. Returns the files' names."""

    def run(batches):
        import os

        import pandas as pd
        from pyarrow import fs

        for pdf in batches:
            made = []
            for image, value in zip(pdf[key], pdf["value"]):
                target = f"{path}/{os.path.splitext(os.path.basename(image))[0]}.txt"
                place, at = fs.FileSystem.from_uri(target) if "://" in target or target.startswith("file:/") else (fs.LocalFileSystem(), target)
                place.create_dir(os.path.dirname(at), recursive=True)
                with place.open_output_stream(at) as out:
                    out.write(value.encode())
                made.append(target)
            yield pd.DataFrame({"file": made})

    return pages.select(key, "value").mapInPandas(run, "file string")


def write_failures(review: DataFrame, path: str, base: str | None = None) -> DataFrame | None:
    """The failure review as CSV, and with `base` the crops beside it, under their own names; of several of a name one stays."""
    shown = {c: F.array_join(c, "; ") for c, t in review.dtypes if t == "array<string>"}
    review.select(*(shown.get(c, F.col(c)).alias(c) for c in review.columns)).write.mode("overwrite").csv(f"{path}/review", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if base is None or "CropPath" not in review.columns:
        return None
    crops = review.where("CropPath <> ''").select("CropPath", F.concat(F.lit(f"{path}/crops/"), F.substring_index("CropPath", "/", -1)).alias("target"))
    return copied(crops.groupBy("target").agg(F.min("CropPath").alias("CropPath")), "CropPath", "target", base)


def append_labels(rows: DataFrame, path: str, web: bool = True) -> None:
    """Appends to the label log as a batch of its own, numbered after those before. web: a blank label is written as <EMPTY>; else labels are
    written as they are, and without the prediction. A number is claimed by a file that only one writer can make."""
    spark = rows.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    claims = jvm.Path(f"{path}/_claims")
    fs.mkdirs(claims)
    number = max((int(s.getPath().getName()) for s in fs.listStatus(claims)), default=-1) + 1
    while True:
        try:
            fs.create(jvm.Path(f"{path}/_claims/{number:08d}"), False).close()
            break
        except Exception as e:  # taken by another writer meanwhile
            if "exist" not in str(e).lower():
                raise
            number += 1
    blank = F.trim(F.coalesce("label", F.lit(""))) == ""
    rows = rows.withColumn("label", F.when(blank, "<EMPTY>").otherwise(F.col("label"))) if web else rows.withColumn("pred_raw", F.lit(""))
    rows.select(*(c.split()[0] for c in LOG.split(", "))).write.csv(f"{path}/batch-{number:08d}", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def copied(files: DataFrame, source: str, target: str, base: str | None = None) -> DataFrame:
    """Copies the files that column `source` names into a folder under the names of column `target`; what is there already stays. Returns target and
    done: copied, there, or missing. base: where relative paths are tried. Files are streamed by the tasks and never held whole."""

    def run(batches):
        import os

        import pandas as pd
        from pyarrow import fs

        def place(path: str):
            return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (fs.LocalFileSystem(), path)

        def one(src: str | None, dst: str) -> str:
            for path in [src, f"{base}/{src}"] if src and base and "://" not in src and not os.path.isabs(src) else [src]:
                if not path or (own := place(path))[0].get_file_info(own[1]).type != fs.FileType.File:
                    continue
                there, at = place(dst)
                if there.get_file_info(at).type == fs.FileType.File:
                    return "there"
                there.create_dir(os.path.dirname(at), recursive=True)
                fs.copy_files(own[1], at, source_filesystem=own[0], destination_filesystem=there)
                return "copied"
            return "missing"

        for pdf in batches:
            yield pd.DataFrame({"target": pdf[target], "done": [one(s, t) for s, t in zip(pdf[source], pdf[target])]})

    return files.select(source, target).mapInPandas(run, "target string, done string")


def document(head: str, rows: DataFrame, foot: str, order: str, between: str = "") -> DataFrame:
    """(part, at, value): the lines of one document: head, rows (order, value), foot. It is written in this order and never held whole.
    between: put before each row but the first."""
    spark = rows.sparkSession
    first = rows.agg(F.min(order).alias("_least"))
    own = rows.crossJoin(F.broadcast(first)).select(F.lit(1).alias("part"), F.col(order).cast("long").alias("at"), F.when(F.col(order) == F.col("_least"), F.col("value")).otherwise(F.concat(F.lit(between), "value")).alias("value"))
    ends = spark.createDataFrame([(0, 0, head), (2, 0, foot)], "part int, at long, value string")
    return own.unionByName(ends)


def write_document(lines: DataFrame, path: str) -> None:
    """The lines as text files that make up the document in the order of their names."""
    lines.orderBy("part", "at").select("value").write.mode("overwrite").text(path)


def gallery(df: DataFrame, cols: list[str], order: str) -> DataFrame:
    """Lines of an HTML table with a row a record, texts escaped; a column named image holds a data URI."""
    cell = lambda c: F.concat(F.lit('<td><img src="'), F.coalesce(c, F.lit("")), F.lit('"/></td>')) if c == "image" else F.concat(F.lit("<td>"), text.html_escaped(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>"))
    rows = df.select(order, F.concat(F.lit("<tr>"), *map(cell, cols), F.lit("</tr>")).alias("value"))
    head = "".join(f"<th>{c}</th>" for c in cols)
    return document(f'<!doctype html><meta charset="utf-8"/><table><tr>{head}</tr>', rows, "</table>", order)
