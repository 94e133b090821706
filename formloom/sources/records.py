"""Tolerant reading of JSON and JSONL records: whatever the shape, each value becomes a row, and each fault too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text

#: Names under which a field may come, first ones first.
ALIASES = {
    "TimesheetID": "timesheet_id timesheetId", "Page": "page_id page", "_field_id": "field_id fieldId", "Row": "row", "Col": "col",
    "FieldKey": "field_key fieldKey", "RawText": "raw_text text rawText ocr_text ocrText pred_text prediction pred label value",
    "NormalizedTime": "normalized_time normalizedTime norm_time normTime", "Confidence": "confidence conf score prob probability conf_score",
    "CropPath": "crop_path cropPath path image_path imagePath",
}


#: Extensions of images.
IMAGES = "jpg jpeg png tif tiff bmp webp".split()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: under spark.checkpoint.dir, or on one machine a temporary one where that is not set."""
    import tempfile
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.gettempdir()
    return f"{shared.rstrip('/')}/formloom-{name}-{uuid.uuid4().hex}"


def _found(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and what is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, list(fs.globStatus(at) or [])


def _exists(spark: SparkSession, path: str) -> None:
    if not _found(spark, path)[1]:
        raise FileNotFoundError(path)


def expanded(spark: SparkSession, path: str) -> list[str]:
    """A file, the images of a folder (not of folders below), or the files that a pattern matches; sorted."""
    fs, found = _found(spark, path)
    if len(found) == 1 and found[0].isDirectory():
        found = [s for s in fs.listStatus(found[0].getPath()) if str(s.getPath()).rsplit(".", 1)[-1].lower() in IMAGES]
    return sorted(str(s.getPath()) for s in found if s.isFile())


def _parsed(df: DataFrame, lines: bool) -> DataFrame:
    """A row a record from (file, line, value). record is JSON text of an object; other values are wrapped as _raw; faults are null."""
    v = F.try_parse_json("value")
    df = df.withColumn("_v", v)
    kind = F.when(F.col("_v").isNull(), "fault").otherwise(F.schema_of_variant("_v"))
    df = df.withColumn("_kind", F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "list").otherwise(kind))
    results = F.try_variant_get("_v", "$.results", "array<variant>")
    one = F.array(F.col("_v"))
    items = F.when(F.col("_kind") == "list", F.try_variant_get("_v", "$", "array<variant>")).when((F.col("_kind") == "object") & results.isNotNull(), results)
    if not lines:
        items = items.when(F.col("_kind") == "object", F.map_values(F.try_variant_get("_v", "$", "map<string,variant>")))
    df = df.withColumn("_items", F.when(F.col("_kind") == "fault", F.array(F.lit(None).cast("variant"))).otherwise(items.otherwise(one)))
    df = df.select("file", "line", "_kind", F.posexplode("_items").alias("item", "_item"))
    shape = F.schema_of_variant("_item")
    record = F.when(F.col("_kind") == "fault", None).when(shape.startswith("OBJECT"), F.to_json("_item"))
    record = record.otherwise(F.to_json(F.struct(F.col("_item").cast("string").alias("_raw"))))
    fault = F.concat(F.lit("jsonl_line_error:"), F.col("line").cast("string")) if lines else F.lit("json_error:")
    return df.select("file", "line", "item", record.alias("record"), F.when(F.col("_kind") == "fault", fault).alias("fault"))


def numbered_lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(file, line, value) of text files, lines numbered from 1 by file. Files are split: a line's number is its place in its block and the
    number of lines of the file's blocks before."""
    raw = spark.read.text(path, pathGlobFilter=pattern, recursiveFileLookup=True)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_at"), "value")
    blocks = raw.groupBy("file", "block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("file", "block", (before + 1 - F.col("_first")).alias("_shift"))
    return raw.join(blocks, ["file", "block"]).select("file", (F.col("_at") + F.col("_shift")).alias("line"), "value")


def jsonl(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, item, record, fault) of all .jsonl files under a path. Lines are numbered by file; blank ones are skipped."""
    _exists(spark, path)
    return _parsed(numbered_lines(spark, path, "*.jsonl").where(F.trim("value") != ""), lines=True)


def strict_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSONL files; a line that is no such record is an error."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def json_files(spark: SparkSession, path: str) -> DataFrame:
    """The same of all .json files; an object without results gives its values."""
    _exists(spark, path)
    raw = spark.read.text(path, wholetext=True, pathGlobFilter="*.json", recursiveFileLookup=True)
    return _parsed(raw.select(F.col("_metadata.file_path").alias("file"), F.lit(0).alias("line"), "value"), lines=False)


def discovered(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of all paths; .json files come before .jsonl files in `part`."""
    out = None
    for path in paths:
        for part, read in enumerate((json_files, jsonl)):
            own = read(spark, path).withColumn("part", F.lit(part))
            out = own if out is None else out.unionByName(own)
    return out


def first_of(record: Column, names: str) -> Column:
    """The first of the names that is there and not null."""
    return F.coalesce(*(F.get_json_object(record, f"$.{n}") for n in names.split()))


def export_records(df: DataFrame) -> DataFrame:
    """Records in the export's columns. A sheet without id is named by its folder; row, column and field are filled from ids and paths.
    Values that are no objects keep their text in RawText."""
    df = df.withColumns({k: first_of(F.col("record"), v) for k, v in ALIASES.items()})
    df = df.withColumn("RawText", F.coalesce("RawText", F.get_json_object("record", "$._raw")))
    df = df.withColumn("TimesheetID", F.coalesce("TimesheetID", F.try_element_at(F.split("file", "/"), F.lit(-2))))
    own = F.coalesce(F.from_json(F.coalesce(F.get_json_object("record", "$.Warnings"), F.get_json_object("record", "$.warnings")), "array<string>"), F.array().cast("array<string>"))
    df = df.withColumn("Warnings", F.concat(own, F.array_compact(F.array("fault"))))
    df = df.withColumns({"Row": F.col("Row").try_cast("int"), "Col": F.col("Col").try_cast("int"), "Confidence": F.col("Confidence")})
    df = text.row_col(df, "Row", "Col", "_field_id", "CropPath").withColumn("FieldKey", F.coalesce("FieldKey", text.path_key(F.col("CropPath"))))
    names = ["TimesheetID", "Page", "Row", "Col", "FieldKey", "RawText", "NormalizedTime", "Confidence", "CropPath", "Warnings"]
    return df.select(*names, F.col("file").alias("_source_file"), "line", "item")


def keyed(df: DataFrame, key: str, pos: list[str]) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*pos)).alias("_r")).select(key, "_r.*")


def label_folder(spark: SparkSession, path: str) -> DataFrame:
    """(image_id, field_name, text, bbox) of a folder of label files, one JSON a page; missing text is empty."""
    schema = "image_id string, fields map<string, struct<text:string, bbox:array<int>>>"
    pages = spark.read.schema(schema).json(path, multiLine=True, pathGlobFilter="*.json")
    return pages.select("image_id", F.explode("fields").alias("field_name", "f")).select("image_id", "field_name", F.coalesce("f.text", F.lit("")).alias("text"), "f.bbox")


def images(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Paths of image files, without reading them."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.{" + ",".join("".join(f"[{c}{c.upper()}]" for c in e) for e in IMAGES) + "}").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return found.select("path", "length")


def latest_csv(spark: SparkSession, path: str, prefix: str = "time_fields_long_") -> DataFrame:
    """The CSV file of the greatest name."""
    _exists(spark, path)
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{prefix}*.csv")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    if not len(found):
        raise FileNotFoundError(f"{path}/{prefix}*.csv")
    return spark.read.csv(max(str(s.getPath()) for s in found), header=True, inferSchema=True, escape='"')


LOG = "crop_path string, field_type string, pred_raw string, label string, reviewer string, ts long"


def label_log(spark: SparkSession, path: str) -> DataFrame:
    """The label log with pos, its order: by batch as appended, and in a batch or a single file by line. The time stamp is not looked at."""
    rows = spark.read.schema(LOG).csv(path, header=True, escape='"', multiLine=True, recursiveFileLookup=True)
    # Quoted files are not split, so ids rise along a file; names of batches and their parts sort as they were written.
    return rows.withColumn("pos", F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line")))


def probe(df: DataFrame, n: int = 2) -> DataFrame:
    """Of the first records: keys, the image they name, the kind of their fields, and the first fields' keys."""
    at = lambda k: F.get_json_object("record", f"$.{k}")
    some = lambda v: F.when(~v.isin("", "{}", "[]", "0", "false"), v)
    fields = F.coalesce(*(some(at(k)) for k in ("fields", "labels", "annotations")))
    kind = F.when(fields.startswith("{"), "dict").when(fields.startswith("["), "list").when(fields.isNull(), "none").otherwise("value")
    inner = F.when(kind == "dict", fields).when(kind == "list", F.get_json_object(fields, "$[0]"))
    image = F.coalesce(some(at("image")), some(at("image_path")), F.concat(some(at("image_id")), F.lit(".png")))
    first = df.orderBy("file", "line", "item").limit(n)
    return first.select("file", "line", F.json_object_keys("record").alias("keys"), image.alias("image"), kind.alias("kind"), F.slice(F.json_object_keys(inner), 1, 10).alias("field_keys"))


def review_items(df: DataFrame, pos: str, field_type: str) -> DataFrame:
    """What the correction page shows of predictions: idx from 0 in order, the crop, and the prediction as suggestion."""
    raw = text.strip(F.coalesce(F.nullif("pred_time", F.lit("")), F.nullif("pred_text", F.lit("")), F.lit("")))
    idx = F.row_number().over(Window.orderBy(pos)) - 1  # a list that a person goes through
    return df.select(idx.alias("idx"), "crop_path", F.lit(field_type).alias("field_type"), raw.alias("pred_raw"), raw.alias("suggest"))


def loaded(path: str | None) -> dict:
    """Settings of a YAML file, with numbers, truth values and nesting; none without a path or of an empty file."""
    if not path:
        return {}
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def config(path: str | None, given: dict) -> dict:
    """Settings with those of a YAML file put over them where they are not null. Nested ones are refused where a plain one is meant."""
    own = loaded(path)
    for key, value in own.items():
        if isinstance(value, dict) and not isinstance(given.get(key), dict):
            raise ValueError(f"{key} is nested")
    return given | {k: v for k, v in own.items() if v is not None}


def heads(path: str) -> dict[str, dict]:
    """Models by field type: {type: {model_id, ckpt_path}}."""
    return {kind: {"model_id": spec["model_id"], "ckpt_path": spec.get("ckpt_path")} for kind, spec in loaded(path).items()}
