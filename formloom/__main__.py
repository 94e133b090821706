"""Command line: python -m formloom export --in PATH... --out FOLDER [--conf-thresh 0.35]; python -m formloom label --log FOLDER --crop PATH --label TEXT;
python -m formloom page --detections JSONL --out FOLDER."""

import argparse
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import layout, models, validate
from .sources import records, sinks


def main(args: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="formloom")
    sub = ap.add_subparsers(dest="what", required=True)
    export = sub.add_parser("export", help="records of JSON files to detail and summary CSV")
    export.add_argument("--in", dest="inputs", nargs="+", required=True)
    export.add_argument("--out", default="./exports")
    export.add_argument("--conf-thresh", type=float, default=0.35)
    label = sub.add_parser("label", help="append one label to the log")
    label.add_argument("--log", required=True)
    label.add_argument("--crop", required=True)
    label.add_argument("--label", required=True)
    label.add_argument("--field-type", default="time")
    label.add_argument("--reviewer", default="")
    page = sub.add_parser("page", help="detections of pages to their results: grid, measures, detections")
    page.add_argument("--detections", required=True)
    page.add_argument("--out", required=True)
    page.add_argument("--header-rows", type=int, default=2)
    page.add_argument("--conf", type=float, default=0.25)
    a, spark = ap.parse_args(args), SparkSession.builder.getOrCreate()
    if a.what == "export":
        found = records.export_records(records.discovered(spark, a.inputs))
        detail = validate.validated(validate.normalized(found), a.conf_thresh)
        own = validate.in_order(detail, "_source_file", "line", "item").drop("line", "item")
        sinks.write_export(own, validate.summarized(detail).orderBy("TimesheetID"), a.out, time.strftime("%Y%m%d_%H%M%S"))
    elif a.what == "page":
        found = records.strict_jsonl(spark, a.detections, models.DETECTION).where(F.col("score") >= a.conf)
        form = layout.Layout(headers=a.header_rows)
        layout.page_json(layout.grid(found, layout=form), found, layout=form).select("result").write.mode("overwrite").text(a.out)
    else:
        row = [(a.crop, a.field_type, "", a.label, a.reviewer, int(time.time()))]
        sinks.append_labels(spark.createDataFrame(row, records.LOG), a.log, web=False)


if __name__ == "__main__":
    main()
