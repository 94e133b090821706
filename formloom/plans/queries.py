"""The registered queries of the library's operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import datasets, evaluate, labels, layout, models, nbest, validate
from ..sources import records, sinks, synth
from ..streaming import labels as stream
from . import samples


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _sample(df: DataFrame, keep: list[str], **made: str) -> DataFrame:
    return df.select(*keep, *(F.expr(samples.for_spark(e)).alias(n) for n, e in made.items()))


def _lines(spark: SparkSession, sf: str, **made: str) -> DataFrame:
    return _sample(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], **made)


def _export(spark: SparkSession, sf: str) -> DataFrame:
    df = _lines(spark, sf, RawText=f"case when l_partkey % 50 = 0 then null else {samples.TIME} end", TimesheetID="case when l_orderkey % 500 = 7 then null else l_orderkey % 500 end", Confidence="case when l_suppkey % 40 = 0 then null else round(l_discount * 10, 2) end")
    return validate.validated(validate.normalized(df))


def export_time_summary(spark: SparkSession, sf: str) -> DataFrame:
    return validate.summarized(_export(spark, sf))


def export_time_detail(spark: SparkSession, sf: str) -> DataFrame:
    return _export(spark, sf).select("l_orderkey", "l_linenumber", "RawText", "NormalizedTime", F.array_join("Warnings", "; ").alias("Warnings"), F.col("IsValid").cast("int").alias("IsValid"))


def time_three_way(spark: SparkSession, sf: str) -> DataFrame:
    df = text.time_lenient(text.time_strict(_lines(spark, sf, raw=samples.TIME), "raw", "strict"), "raw", "lenient")
    return text.time_parsed(df, "raw", "parsed", "w").drop("w")


def amount_sanitize(spark: SparkSession, sf: str) -> DataFrame:
    return text.amount(_lines(spark, sf, raw=samples.AMOUNT), "raw", "amount")


def amount_canon(spark: SparkSession, sf: str) -> DataFrame:
    return text.canon_amount(_lines(spark, sf, raw=samples.AMOUNT), "raw", "canon")


def date_sanitize(spark: SparkSession, sf: str) -> DataFrame:
    return text.date(_sample(table(spark, sf, "orders"), ["o_orderkey"], raw=samples.DATE), "raw", "day")


def minutes_worked(spark: SparkSession, sf: str) -> DataFrame:
    df = _lines(spark, sf, t_in="cast(l_orderkey % 12 as string) || ':' || lpad(cast(l_partkey % 60 as string), 2, '0')", t_out="cast(12 + l_suppkey % 12 as string) || lpad(cast(l_partkey % 60 as string), 2, '0')")
    df = text.time_lenient(text.time_lenient(df, "t_in", "a"), "t_out", "b")
    worked = text.minutes(F.col("b")) - text.minutes(F.col("a"))
    return df.select("l_orderkey", "l_linenumber", worked.alias("minutes"), text.from_minutes(worked).alias("worked"))


def alias_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    body = """case o_orderkey % 4 when 0 then '{"conf":0.' || cast(o_orderkey % 10 as string) || ',"text":"a' || cast(o_custkey as string) || '"}'
      when 1 then '{"text":null,"pred":"b' || cast(o_custkey as string) || '","score":"x"}' when 2 then '{"label":' || cast(o_custkey as string) || '}' else '{}' end"""
    df = _sample(table(spark, sf, "orders"), ["o_orderkey"], body=body)
    first = lambda n: records.first_of(F.col("body"), records.ALIASES[n])
    return df.select("o_orderkey", first("RawText").alias("raw_text"), first("Confidence").alias("confidence"))


def json_shapes(spark: SparkSession, sf: str) -> DataFrame:
    value = """case o_orderkey % 6 when 0 then '{"text":"t' || cast(o_custkey as string) || '"}' when 1 then '[{"text":"x"},{"text":"y' || cast(o_custkey as string) || '"}]'
      when 2 then '{"results":[{"pred":"r"},{"pred":"s"},{"pred":"t"}]}' when 3 then cast(o_custkey as string) when 4 then '   ' else '{bad' end"""
    df = _sample(table(spark, sf, "orders"), ["o_orderkey"], value=value).where(F.trim("value") != "")
    rows = records._parsed(df.select(F.lit("f").alias("file"), F.col("o_orderkey").alias("line"), "value"), lines=True)
    own = F.coalesce(records.first_of(F.col("record"), records.ALIASES["RawText"]), F.get_json_object("record", "$._raw"))
    return rows.select(F.col("line").alias("o_orderkey"), F.col("item").cast("long").alias("item"), own.alias("raw_text"), "fault")


def row_col_infer(spark: SparkSession, sf: str) -> DataFrame:
    df = _lines(spark, sf, f="case when l_linenumber % 3 = 0 then null else 'Row-' || cast(l_partkey % 12 as string) end", p="'img/row_' || cast(l_suppkey % 9 as string) || '/COL ' || cast(l_linenumber as string) || '.png'")
    df = df.withColumns({"row": F.lit(None).cast("int"), "col": F.when(F.col("l_orderkey") % 2 == 0, F.lit(77))})
    return text.row_col(df, "row", "col", "f", "p").select("l_orderkey", "l_linenumber", "row", "col")


def crop_path_parse(spark: SparkSession, sf: str) -> DataFrame:
    df = _lines(spark, sf, p="'root\\\\img' || cast(l_suppkey as string) || '\\\\time/row' || cast(l_partkey % 12 as string) || '_clock_IN_am.v' || cast(l_linenumber as string) || '.png'")
    image, field = text.crop_parts(F.col("p"))
    return df.select("l_orderkey", "l_linenumber", image.alias("image_id"), field.alias("field"), text.path_key(F.col("p")).alias("key"))


def bucket_fields(spark: SparkSession, sf: str) -> DataFrame:
    df = _lines(spark, sf, k=samples.KEY)
    return df.groupBy("k").agg(F.count("*").alias("n")).select("k", "n", text.bucket(F.col("k")).alias("bucket"), text.field_type(F.col("k")).alias("ftype"), text.field_class(F.col("k")).alias("cls"))


_CANDIDATE = """case k when 0 then '$' || cast(cast(floor(o_totalprice) as bigint) as string) || '.5' when 1 then cast(o_custkey as string) || ',' || lpad(cast(o_orderkey % 100 as string), 2, '0')
  when 2 then 'l' || cast(o_custkey as string) || '.00' else '  ' || cast(o_custkey as string) || '.00  ' end"""


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    df = _sample(df, ["o_orderkey", "k"], cand=_CANDIDATE)
    packed = df.groupBy("o_orderkey").agg(F.sort_array(F.collect_list(F.struct("k", "cand"))).alias("c"))
    return packed.select("o_orderkey", F.transform("c", lambda x: x["cand"]).alias("candidates"), F.transform("c", lambda x: x["k"] * -0.25).alias("logprobs"))


def nbest_rescore(spark: SparkSession, sf: str) -> DataFrame:
    out = nbest.ranked(nbest.exploded(_candidates(spark, sf), "candidates", "logprobs"), ["o_orderkey"], "amount")
    return out.select("o_orderkey", F.col("pos").cast("long").alias("pos"), "cand", F.round("score", 6).alias("score"), "note", F.col("rank").cast("long").alias("rank"))


def local_choice(spark: SparkSession, sf: str) -> DataFrame:
    out = nbest.local_choice(nbest.exploded(_candidates(spark, sf), "candidates", "logprobs"), ["o_orderkey"], "amount")
    return out.withColumn("total", F.round("total", 6))


def triage_conf(spark: SparkSession, sf: str) -> DataFrame:
    df = _candidates(spark, sf).select("o_orderkey", F.col("candidates")[3].alias("pred"), nbest.confidence(F.transform("logprobs", lambda x: x * (F.col("o_orderkey") % 9))).alias("conf"))
    out = nbest.triaged(df, "pred", "conf", "amount")
    return out.select("o_orderkey", F.round("conf", 4).alias("conf"), "clean", "sanitized", "valid", "final_conf", "needs_review")


def cer_exact_match(spark: SparkSession, sf: str) -> DataFrame:
    df = _sample(table(spark, sf, "part"), ["p_brand", "p_name"], pred="case when p_partkey % 3 = 0 then p_name else replace(replace(p_name, 'a', 'o'), 'e', '') end")
    return evaluate.match_and_cer(df, "pred", "p_name", ["p_brand"]).withColumns({c: F.round(c, 6) for c in ("em", "cer")})


_TRUTH = "lpad(cast(o_custkey % 24 as string), 2, '0') || ':' || lpad(cast(o_orderkey % 60 as string), 2, '0')"
_PRED = f"case o_orderkey % 5 when 0 then 'junk' when 1 then replace({_TRUTH}, ':', '.') when 2 then lpad(cast((o_custkey + 1) % 24 as string), 2, '0') || ':' || lpad(cast(o_orderkey % 4 * 15 as string), 2, '0') else {_TRUTH} end"


def _tags(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    # Truth of some rows goes by another key, so that the join finds none for them.
    truth = _sample(orders, [], o_orderkey="case when o_orderkey % 11 = 0 then -1 - o_orderkey else o_orderkey end", gt=f"case when o_orderkey % 13 = 0 then '' else {_TRUTH} end")
    return evaluate.tagged(_sample(orders, ["o_orderkey"], pred=_PRED), truth, ["o_orderkey"], "pred", "gt")


def accuracy_report(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.report(_tags(spark, sf)).withColumn("rate", F.round("rate", 6))


def confusion_topk(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion(_tags(spark, sf))


def eval_per_column(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    truth = _sample(orders, ["o_orderkey"], in_am=_TRUTH, note="' ' || o_orderpriority", day=samples.DATE)
    preds = _sample(orders, [], o_orderkey="case when o_orderkey % 7 = 0 then -1 - o_orderkey else o_orderkey end", in_am=_PRED, note="case when o_orderkey % 2 = 0 then o_orderpriority end", day=samples.DATE)
    out = evaluate.by_column(truth, preds, "o_orderkey", {"in_am": "time", "note": "text", "day": "date"})
    return out.withColumn("rate", F.round("rate", 6))


def _log(df: DataFrame) -> DataFrame:
    label = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.concat("event_type", F.lit(":"), (F.col("event_id") % 24).cast("string")))
    return df.select(F.col("user_id").cast("string").alias("crop_path"), label.alias("label"), F.col("event_id").alias("pos"))


def labels_latest(spark: SparkSession, sf: str) -> DataFrame:
    return labels.latest(_log(table(spark, sf, "events")), "crop_path", "pos")


def labels_gold(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(table(spark, sf, "events")).withColumn("label", F.when(F.col("pos") % 2 == 0, F.concat((F.col("pos") % 24).cast("string"), F.lit(";30"))).otherwise(F.col("label")))
    return labels.gold(log, "crop_path", "pos", "label", "time")


def labels_latest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Latest labels from a stream that works off the events table and ends."""
    events = table(spark, sf, "events")
    # Streams read folders of files; a table may be either one.
    source = spark.readStream.schema(events.schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/events.parquet*")
    out = records.shared_folder(spark, "stream")
    stream.run_once(stream.latest(_log(source), "crop_path", "pos", ["label"]), f"{out}/result", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/result").select("crop_path", "label", "pos")


def missing_images(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "lineitem").where("l_quantity > 25").select(F.col("l_orderkey").alias("o_orderkey"))
    return datasets.missing(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), files, "o_orderkey")


_CY = "510 + (l_orderkey % 12) * 120 + (l_partkey % 161 - 80) * 0.75"


def grid_row_bin(spark: SparkSession, sf: str) -> DataFrame:
    df = _lines(spark, sf, cy=f"cast({_CY} as double)")
    return df.select("l_orderkey", "l_linenumber", layout.row_index(F.col("cy")).alias("row_tops"), layout.row_index(F.col("cy"), mode="centered").alias("row_centered"))


def row_histogram(spark: SparkSession, sf: str) -> DataFrame:
    out = layout.row_histogram(_lines(spark, sf, cy=f"cast({_CY} as double)"), "cy")
    return out.withColumn("n", F.col("n").cast("long"))


def _detections(spark: SparkSession, sf: str) -> DataFrame:
    form = layout.offsets(spark).select("col_idx", "x_center")
    df = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"))
    df = df.join(F.broadcast(form), df.l_linenumber - 1 == form.col_idx)
    x = F.col("x_center") + F.col("l_partkey") % 61 - 30 - 20
    y = F.lit(510.0) + (F.col("l_orderkey") % 12) * 120 - 15
    return df.select(
        F.col("l_orderkey").alias("page_id"), F.col("l_linenumber").alias("det_idx"), F.when(F.col("l_suppkey") % 10 == 0, "date").otherwise("field").alias("cls"),
        x.cast("double").alias("x"), y.cast("double").alias("y"), F.lit(40.0).alias("w"), F.lit(30.0).alias("h"), F.lit(0.9).alias("score"),
    )


def grid_assign(spark: SparkSession, sf: str) -> DataFrame:
    return layout.grid(_detections(spark, sf)).where("det is not null").select("page_id", "row_idx", "col_idx", F.col("det.det_idx").alias("det_idx"), "name")


def page_json(spark: SparkSession, sf: str) -> DataFrame:
    found = _detections(spark, sf)
    return layout.page_json(layout.grid(found), found)


def layout_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return layout.cells(spark).select("row_idx", "col_idx", "name", "x0", "x_center", "y0")


def _fields(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").withColumn("pos", (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey"))
    return _sample(df, ["pos"], page_image=samples.PAGE, field_name=samples.FIELD, x="cast(l_partkey % 1500 as int)", y="cast(l_suppkey % 2000 as int)", w="cast(20 + l_linenumber as int)", h="cast(30 + l_orderkey % 7 as int)")


def coco_annotations(spark: SparkSession, sf: str) -> DataFrame:
    return datasets.coco_annotations(_fields(spark, sf)).withColumn("bbox", F.array_join(F.transform("bbox", lambda b: b.cast("string")), ","))


def coco_images(spark: SparkSession, sf: str) -> DataFrame:
    return datasets.coco_images(_fields(spark, sf))


def yolo_lines(spark: SparkSession, sf: str) -> DataFrame:
    df = _fields(spark, sf).withColumns({"page_width": F.lit(1700), "page_height": F.lit(2200)})
    return datasets.yolo_lines(df)


def crop_manifest(spark: SparkSession, sf: str) -> DataFrame:
    df = _fields(spark, sf).select("pos", F.col("page_image").alias("image_id"), "field_name", F.array("x", "y", F.col("x") + F.col("w"), F.col("y") + F.col("h")).alias("bbox"))
    out = datasets.crop_manifest(df).withColumn("bbox", F.array_join(F.transform("bbox", lambda b: b.cast("string")), ","))
    return out.groupBy("image_id", "field_name", "bucket", "crop_path", "bbox").agg(F.count("*").alias("n"))


_BOX = """case l_linenumber % 5 when 0 then '{"x":' || cast(l_partkey % 900 as string) || ',"y":10,"w":20.5,"h":' || cast(l_suppkey % 50 as string) || '}'
  when 1 then '[' || cast(l_partkey % 900 as string) || ',5,' || cast(l_suppkey % 900 as string) || ',40]' when 2 then '{"left":1,"top":2,"right":' || cast(l_partkey % 900 as string) || ',"bottom":9}'
  when 3 then '[1,2,' || cast(l_partkey % 900 as string) || ',2,7,' || cast(l_suppkey % 50 as string) || ',0,8]' else '{"note":1}' end"""


def bbox_any(spark: SparkSession, sf: str) -> DataFrame:
    df = _lines(spark, sf, box=_BOX)
    return df.select("l_orderkey", "l_linenumber", F.array_join(F.transform(layout.any_box(F.col("box")), lambda b: b.cast("string")), ",").alias("bbox"))


def dataset_lint(spark: SparkSession, sf: str) -> DataFrame:
    df = _lines(spark, sf, raw=f"case when l_partkey % 3 = 0 then {samples.TIME} when l_partkey % 3 = 1 then cast(l_suppkey as string) || '.00' else lpad(cast(l_orderkey % 24 as string), 2, '0') || ':' || lpad(cast(l_partkey % 60 as string), 2, '0') end", here="l_suppkey % 20 <> 0", split="case when l_orderkey % 10 = 0 then 'val' else 'train' end")
    return datasets.lint_report(datasets.linted(df, "raw", "here"), "split")


def split_exact(spark: SparkSession, sf: str) -> DataFrame:
    return labels.split_exact(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.15)


def failure_reasons(spark: SparkSession, sf: str) -> DataFrame:
    failed = validate.failures(_export(spark, sf))
    return validate.top_values(failed.where("Reason <> ''"), "Reason", 10)


def failure_texts(spark: SparkSession, sf: str) -> DataFrame:
    return validate.top_values(validate.failures(_export(spark, sf)), "CleanText", 15)


def union_inputs(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "customer").select(F.col("c_name").alias("text"), F.col("c_mktsegment").alias("field_type"))
    b = table(spark, sf, "supplier").select(F.col("s_name").alias("text"), F.col("s_nationkey").cast("long").alias("page"))
    return datasets.merged(a, b)


def text_clean(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "conversations")
    return df.select("conv_id", "turn", text.html_escaped(text.squeezed(F.col("text"))).alias("text"))


def label_import(spark: SparkSession, sf: str) -> DataFrame:
    lines, boxes = _import(spark, sf)
    return datasets.imported(lines, boxes).groupBy("ftype").agg(F.count("*").alias("fields"), F.count("text").alias("with_text"), F.sum(F.expr("bbox[2] - bbox[0]")).alias("width"))


def _import(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    base = _lines(spark, sf, image_id="cast(l_suppkey as string)", key=f"{samples.KEY} || cast(l_orderkey as string) || case l_linenumber % 7 when 0 then '_clock_in_am' when 2 then '_total_hours' else '' end", value=f"case l_linenumber % 7 when 0 then {samples.TIME} when 2 then {samples.AMOUNT} when 3 then '<EMPTY>' else ' plain ' end", box=_BOX)
    other = F.when(F.col("l_orderkey") % 5 == 0, F.concat(F.lit("no "), "image_id")).otherwise(F.col("image_id"))
    return base.select("image_id", "key", "value"), base.select(other.alias("image_id"), "key", "box")


def synth_crops(spark: SparkSession, sf: str) -> DataFrame:
    df = synth.crops(spark, 200)
    return df.withColumn("bbox_xywh", F.array_join(F.transform("bbox_xywh", lambda b: b.cast("string")), ","))


def events_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by hour and kind from a stream with a watermark; complete results."""
    events = table(spark, sf, "events")
    source = spark.readStream.schema(events.schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/events.parquet*")
    source = source.withColumn("ts", F.col("ts").cast("timestamp"))
    out = records.shared_folder(spark, "hours")
    stream.run_once(stream.by_hour(source, "ts", "event_type"), f"{out}/result", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/result").select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n")


def _written(spark: SparkSession, lines: DataFrame, path: str, by: str, order: str, name: str) -> None:
    """One text file of this name for each value of `by`, lines in order."""
    lines.repartition(by).sortWithinPartitions(by, order).select(by, "value").write.partitionBy(by).text(path)
    fs, found = records._found(spark, f"{path}/*/part-*")
    for s in found:
        fs.rename(s.getPath(), spark._jvm.org.apache.hadoop.fs.Path(s.getPath().getParent(), name))


_RECORD = """'{"row":' || cast(o_orderkey % 12 as string) || ',"text":' || case when o_orderkey % 5 = 0 then 'null,"pred":"9.' || cast(o_custkey % 60 as string) || '"' else '"' || cast(o_custkey % 26 as string) || ':' || lpad(cast(o_orderkey % 64 as string), 2, '0') || '"' end
  || ',"conf":' || case when o_orderkey % 9 = 0 then '"x"' else '0.' || cast(o_orderkey % 9 as string) end || case when o_orderkey % 4 = 0 then ',"timesheet_id":"T' || cast(o_custkey % 7 as string) || '"' else '' end
  || ',"path":"c/img' || cast(o_custkey as string) || '/ROW' || cast(o_orderkey % 9 as string) || '_clock_in_AM.png"' || case when o_orderkey % 8 = 3 then ',"Warnings":["blurred"]' else '' end || '}'"""
_SHAPE = f"""case o_orderkey % 7 when 1 then '[' || {_RECORD} || ',{{"label":"7"}}]' when 2 then '{{"results":[' || {_RECORD} || ']}}' when 3 then cast(o_custkey % 2400 as string) when 4 then '  ' when 5 then '{{bad' else {_RECORD} end"""


def _records(spark: SparkSession, sf: str, name: str) -> str:
    path = records.shared_folder(spark, name)
    _written(spark, _sample(table(spark, sf, "orders"), ["o_orderkey"], sheet="'s' || cast(o_orderkey % 10 as string)", value=_SHAPE), path, "sheet", "o_orderkey", "r.jsonl")
    return path


def export_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of records of every shape to the export's CSV, and that read again: all its columns are text."""
    path = _records(spark, sf, "export")
    df = validate.validated(validate.normalized(records.export_records(records.discovered(spark, [path]))))
    out = records.shared_folder(spark, "csv")
    sinks.write_export(df.drop("_source_file"), validate.summarized(df), out, "run1")
    return spark.read.csv(f"{out}/detail", header=True, escape='"').select("RunID", "TimesheetID", "Row", "FieldKey", "RawText", "NormalizedTime", "Confidence", "CropPath", "Warnings", "IsValid", "line", "item")


def export_summary_files(spark: SparkSession, sf: str) -> DataFrame:
    path = _records(spark, sf, "export")
    df = validate.validated(validate.normalized(records.export_records(records.discovered(spark, [path]))))
    out = records.shared_folder(spark, "csv")
    sinks.write_export(df.drop("_source_file"), validate.summarized(df), out, "run1")
    return spark.read.csv(f"{out}/summary", header=True, escape='"')


def json_documents(spark: SparkSession, sf: str) -> DataFrame:
    """JSON files of a list, of results, of keyed records, of one value, and one that is none."""
    one = "'{\"text\":\"' || c_name || '\"}'"
    rows = _sample(table(spark, sf, "customer"), ["c_custkey", "c_nationkey"], one=one, entry=f"'\"k' || cast(c_custkey as string) || '\":' || {one}")
    joined = lambda c: F.array_join(F.sort_array(F.collect_list(F.struct("c_custkey", c)))[c], ",").alias(c)
    packed = rows.groupBy("c_nationkey").agg(joined("one"), joined("entry"))
    kind = F.col("c_nationkey") % 5
    value = F.when(kind == 0, F.concat(F.lit("["), "one", F.lit("]"))).when(kind == 1, F.concat(F.lit('{"results":['), "one", F.lit("]}"))).when(kind == 2, F.concat(F.lit("{"), "entry", F.lit("}")))
    path = records.shared_folder(spark, "json")
    _written(spark, packed.select(F.col("c_nationkey").alias("own"), F.lit(0).alias("at"), value.when(kind == 3, F.lit("17")).otherwise(F.lit("{no")).alias("value"), "at").select("own", "value", "at"), path, "own", "at", "d.json")
    rows = records.json_files(spark, path)
    raw = F.coalesce(records.first_of(F.col("record"), records.ALIASES["RawText"]), F.get_json_object("record", "$._raw"))
    return rows.select(F.regexp_extract("file", "own=(\\d+)", 1).cast("int").alias("c_nationkey"), raw.alias("raw_text"), "fault")


def keyed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A strict reading of record files, the last of each key."""
    path = records.shared_folder(spark, "strict")
    made = _sample(table(spark, sf, "orders"), ["o_orderkey"], row="o_custkey % 50", text="o_orderpriority || cast(o_orderkey as string)")
    made.select("row", "text", F.col("o_orderkey").alias("pos")).write.json(path)
    return records.keyed(records.strict_jsonl(spark, path, "row long, text string, pos long"), "row", ["pos"])


def label_log_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of a log of three batches of rising size; the newest time stamp is in the first."""
    path, events = records.shared_folder(spark, "log"), table(spark, sf, "events")
    for batch, share in enumerate((97, 11, 2)):
        label = F.when(F.col("event_id") % 6 == 0, F.lit(" ")).otherwise(F.concat(F.lit(f"{batch}, "), F.lit('"'), "event_type", F.lit('"')))
        own = events.where(F.col("event_id") % share == 0).groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max_by("event_type", "event_id").alias("event_type"))
        rows = own.select(F.col("user_id").cast("string").alias("crop_path"), F.lit("time").alias("field_type"), F.lit("p").alias("pred_raw"), label.alias("label"), F.lit("r").alias("reviewer"), F.lit(9 - batch).cast("long").alias("ts"))
        sinks.append_labels(rows, path, web=batch != 1)
    return labels.latest(records.label_log(spark, path), "crop_path", "pos").select("crop_path", "pred_raw", "label", "ts")


def label_folder(spark: SparkSession, sf: str) -> DataFrame:
    path = records.shared_folder(spark, "labels")
    nation = table(spark, sf, "nation")
    field = F.struct(F.when(F.col("n_nationkey") % 3 > 0, F.col("n_name")).alias("text"), F.array(F.lit(1), F.lit(2), F.col("n_nationkey"), F.lit(4)).alias("bbox"))
    pages = nation.select(F.col("n_name").alias("image_id"), F.create_map(F.lit("clock_in"), field, F.lit("note"), field).alias("fields"))
    pages.write.option("maxRecordsPerFile", 1).json(path)
    out = records.label_folder(spark, path).where(text.is_time_field(F.col("field_name")))
    return out.withColumn("bbox", F.array_join(F.transform("bbox", lambda b: b.cast("string")), ","))


def newest_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = records.shared_folder(spark, "newest")
    nation = table(spark, sf, "nation")
    for day in ("20250101_000000", "20251013_120000", "20250930_235959"):
        nation.select("n_nationkey", F.concat("n_name", F.lit(f" {day}")).alias("name")).coalesce(1).write.csv(f"{path}/{day}", header=True)
        fs, found = records._found(spark, f"{path}/{day}/part-*")
        fs.rename(found[0].getPath(), spark._jvm.org.apache.hadoop.fs.Path(f"{path}/time_fields_long_{day}.csv"))
    return records.latest_csv(spark, path).select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "name")


def image_files(spark: SparkSession, sf: str) -> DataFrame:
    """Images of a folder in order, and whether the listing by tasks finds them, and those below, too."""
    path = records.shared_folder(spark, "images")
    fs, jvm = records._found(spark, path)[0], spark._jvm.org.apache.hadoop.fs
    for name in ("b.png", "a.JPG", "c.tif", "d.TIFF", "e.txt", "f.webp", "g.BMP", "h.jpeg", "below/i.png"):
        out = fs.create(jvm.Path(f"{path}/{name}"))
        out.write(0)  # files without bytes are not listed
        out.close()
    own = [(i, p.rsplit("/", 1)[-1]) for i, p in enumerate(records.expanded(spark, path))]
    name = F.substring_index("path", "/", -1).alias("name")
    listed, below = (records.images(spark, path, r).select(name, F.lit(True).alias(c)) for r, c in ((False, "listed"), (True, "below")))
    order = spark.createDataFrame(own, "place int, name string")
    return order.join(listed, "name", "full").join(below, "name", "full").select("name", "place", "listed", "below")


def schema_probe(spark: SparkSession, sf: str) -> DataFrame:
    path = records.shared_folder(spark, "probe")
    made = "case n_nationkey when 0 then '{\"image\":\"\",\"image_id\":\"p1\",\"fields\":{},\"labels\":[{\"key\":1,\"text\":2}]}' when 1 then '{\"image_path\":\"x.png\",\"fields\":{\"a\":1,\"b\":2}}' else '{\"other\":1}' end"
    _written(spark, _sample(table(spark, sf, "nation"), ["n_nationkey"], own="'f'", value=made), path, "own", "n_nationkey", "l.jsonl")
    out = records.probe(records.jsonl(spark, path), 3)
    return out.select("line", F.array_join("keys", ",").alias("keys"), "image", "kind", F.array_join("field_keys", ",").alias("field_keys"))


def record_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = _sample(table(spark, sf, "orders"), [], record="case when o_orderkey % 2 = 0 then '{\"row\":1,\"in_am\":\"x\"}' else '{\"row\":2,\"k' || cast(o_custkey % 4 as string) || '\":null}' end")
    return spark.createDataFrame([(i, c) for i, c in enumerate(evaluate.columns_of(df))], "place int, name string")


def first_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of the export in its order: sheet, page, row, column, nulls last."""
    df = _sample(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], TimesheetID="case when l_orderkey % 50 < 48 then null else l_orderkey % 50 end", Page="case when l_partkey % 3 = 0 then null else l_partkey % 3 end", Row="l_suppkey % 12", Col="l_linenumber")
    return validate.in_order(df, "l_orderkey", "l_partkey").limit(500).drop("l_partkey")


def import_funnel(spark: SparkSession, sf: str) -> DataFrame:
    lines, boxes = _import(spark, sf)
    files = lines.where(F.col("image_id").cast("long") % 3 > 0).select("image_id")
    return datasets.funnel(lines, boxes, files)


def import_split(spark: SparkSession, sf: str) -> DataFrame:
    """Imported crops with text by type and split: the split is drawn by crop."""
    lines, boxes = _import(spark, sf)
    own = datasets.imported(lines, boxes).where("text is not null and ftype is not null").withColumn("crop", F.concat_ws("__", "image_id", "key"))
    return labels.split_share(own, "crop", 0.15).select("crop", "ftype", "text", "split")


def assembled_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("l_suppkey"))
    name = F.when(F.col("l_linenumber") % 3 == 0, "in_am").when(F.col("l_linenumber") % 3 == 1, "out_am").otherwise("note")
    own = df.select(F.col("l_orderkey").alias("row"), name.alias("name"), F.col("l_linenumber").alias("col_idx"), F.col("l_suppkey").cast("string").alias("value"))
    return layout.assembled(own, ["row"], ["in_am", "out_am", "note"])


def best_epochs(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.max("o_custkey").cast("double").alias("em"))
    return evaluate.best_so_far(days, "d", "em").select(F.col("d").cast("string").alias("epoch"), "em", "is_best")


def sequence_scores(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", F.pmod("l_suppkey", F.lit(4)).cast("int").alias("token"), (-F.col("l_quantity") / 8).alias("logp")).alias("s"))
    seq = df.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("s")).alias("s"))
    return seq.select("l_orderkey", nbest.sequence_logprob(F.col("s.logp"), F.col("s.token"), 3).alias("logprob"))


def hashed_names(spark: SparkSession, sf: str) -> DataFrame:
    df = _sample(table(spark, sf, "part"), ["p_partkey"], p="'/data/' || p_brand || '/' || case when p_partkey % 3 = 0 then '.hidden' when p_partkey % 3 = 1 then p_name || '.v1.png' else p_name end")
    return df.select("p_partkey", text.hashed_name(F.col("p")).alias("name"))


def warnings_split(spark: SparkSession, sf: str) -> DataFrame:
    df = _lines(spark, sf, w="case l_linenumber % 4 when 0 then null when 1 then ' a; ;b' || cast(l_suppkey as string) || ';' when 2 then '' else 'invalid_time' end")
    return df.select("l_orderkey", "l_linenumber", F.array_join(text.split_warnings(F.col("w")), "|").alias("warnings"))


def _crowded(spark: SparkSession, sf: str) -> DataFrame:
    """Detections anywhere in a row: several want one column, and rows may have more of them than columns."""
    df = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    page, row = F.floor(F.col("l_orderkey") / 24), F.floor(F.col("l_orderkey") / 2) % 12
    x, y = F.col("l_partkey") * 37 % 1400 + 80, 510 + row * 120
    return df.select(
        page.alias("page_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("det_idx"), F.lit("field").alias("cls"), x.cast("double").alias("x"),
        (y - 15).cast("double").alias("y"), F.lit(0.0).alias("w"), F.lit(30.0).alias("h"), F.lit(0.9).alias("score"),
    )


def grid_greedy(spark: SparkSession, sf: str) -> DataFrame:
    return layout.grid(_crowded(spark, sf), method="greedy").where("det is not null").select("page_id", "row_idx", "col_idx", F.col("det.det_idx").alias("det_idx"))


def _ranked(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("pos"))
    df = _sample(df, ["o_orderkey", "pos"], cand=CANDIDATES[kind], logp="pos * -0.25D")
    out = nbest.ranked(df, ["o_orderkey"], kind)
    return out.select("o_orderkey", F.col("pos").cast("long").alias("pos"), "cand", F.round("score", 6).alias("score"), "note", F.col("rank").cast("long").alias("rank"))


CANDIDATES = {
    "time": "case pos when 0 then cast(o_custkey % 24 as string) || ';' || lpad(cast(o_orderkey % 60 as string), 2, '0') when 1 then ' l' || cast(o_custkey % 24 as string) || ':30 PM ' else cast(o_custkey % 30 as string) || ':' || cast(o_orderkey % 70 as string) || 'am' end",
    "date": f"case pos when 0 then ({samples.DATE}) when 1 then '1/' || cast(o_custkey % 40 as string) || '/25' else 'on ' || ({samples.DATE}) end",
    "text": "case pos when 0 then '  ' || o_orderpriority || '   x' when 1 then o_orderpriority else '' end",
}


def nbest_time(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf, "time")


def nbest_date(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf, "date")


def nbest_text(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf, "text")


def layout_drawn(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes of a drawn form: above the table, and in its cells."""
    above = spark.createDataFrame(synth.HEADERS, "name string, bx int, by int, bw int, bh int")
    inside = layout.cells(spark, layout.DRAWN).select(F.concat("name", F.lit("_r"), F.col("row_idx") + 1).alias("name"), "bx", "by", "bw", "bh")
    return above.unionByName(inside).select("name", *(F.col(c).cast("int").alias(c) for c in ("bx", "by", "bw", "bh")))


def stub_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Detections made of labelled boxes, put into the grid by bands that are taken by their middles."""
    df = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    x, y = F.lit(80) + (F.col("l_linenumber") - 1) * 170, F.lit(510) + F.col("l_orderkey") % 12 * 120
    box = F.when(F.col("l_partkey") % 20 == 0, F.array(F.lit(1))).otherwise(F.array(x + 40, y + 20, x + 130, y + 100).cast("array<int>"))
    fields = df.select(F.col("l_orderkey").cast("string").alias("image_id"), F.col("l_linenumber").alias("pos"), box.alias("bbox"))
    out = layout.grid(models.stub_detections(fields), mode="centered").where("det is not null")
    return out.select("page_id", "row_idx", "det.det_idx", "det.x", "det.w", "det.score")


def _hinted():
    """A head that reads what a crop's hint says, worse readings first."""
    return lambda own: [([f"?{h}", h], [-0.5, -1.0]) for h in own["hint"]]


def router_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Crops to wide rows: classes to types, heads for times and amounts, presence of signatures; lunch is a type without head here."""
    df = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"))
    df = _sample(df, ["l_orderkey", "l_linenumber", "l_suppkey"], cls="case l_linenumber when 1 then 'in_am' when 2 then 'total_hours' when 3 then 'signature' when 4 then 'employee_name' when 5 then 'in_am' when 6 then 'date' else 'unknown' end",
                 hint="case when l_linenumber = 2 then cast(l_partkey as string) || ',5' when l_linenumber = 5 and l_partkey % 2 = 0 then 'none' else cast(l_partkey % 24 as string) || '.15' end")
    crops = models.typed(df).select(F.col("l_orderkey").alias("row"), F.concat_ws("_", "l_orderkey", "l_linenumber").alias("crop_id"), "cls", F.col("l_linenumber").alias("col_idx"), "ftype", "hint", (F.col("l_suppkey") % 3 == 0).alias("signature_present"))
    return models.routed(crops, {"time": _hinted, "amount": _hinted}, ["row"], ["in_am", "total_hours", "signature", "employee_name", "date", "unknown"])


def coco_lines(spark: SparkSession, sf: str) -> DataFrame:
    return datasets.coco_document(_fields(spark, sf))


def yolo_files(spark: SparkSession, sf: str) -> DataFrame:
    df = _fields(spark, sf).withColumns({"page_width": F.lit(1700), "page_height": F.lit(2200)})
    return datasets.yolo_pages(datasets.yolo_lines(df))


def failure_review(spark: SparkSession, sf: str) -> DataFrame:
    out = validate.review(validate.failures(_export(spark, sf)))
    return out.withColumn("Warnings", F.array_join("Warnings", "; "))


def review_page(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("pos"), "role", "text")
    return sinks.gallery(df, ["role", "text"], "pos")


def review_list(spark: SparkSession, sf: str) -> DataFrame:
    df = _sample(table(spark, sf, "customer"), ["c_custkey"], crop_path="'c/' || c_name", pred_time="case c_custkey % 3 when 0 then null when 1 then '' else ' 9:30 ' end", pred_text="case when c_custkey % 4 = 0 then null else c_mktsegment end")
    return records.review_items(df, "c_custkey", "time").withColumn("idx", F.col("idx").cast("long"))


def split_bernoulli(spark: SparkSession, sf: str) -> DataFrame:
    return labels.split_share(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.1)


def export_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The export's records as a stream that works off the customers and ends."""
    customers = table(spark, sf, "customer")
    source = spark.readStream.schema(customers.schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/customer.parquet*")
    made = _sample(source, ["c_custkey"], RawText="cast(c_custkey % 26 as string) || ':' || lpad(cast(c_nationkey * 3 as string), 2, '0')", Confidence="c_custkey % 10 / 10.0D")
    out = records.shared_folder(spark, "exported")
    stream.run_once(stream.exported(made), f"{out}/result", f"{out}/checkpoint", "append")
    return spark.read.parquet(f"{out}/result").select("c_custkey", "RawText", "NormalizedTime", F.array_join("Warnings", "; ").alias("Warnings"), "IsValid")


QUERIES = {
    f.__name__: f
    for f in (
        export_files, export_summary_files, json_documents, keyed_rows, label_log_latest, label_folder, newest_csv, image_files, schema_probe, record_columns,
        first_in_order, import_funnel, import_split, assembled_rows, best_epochs, sequence_scores, hashed_names, warnings_split, grid_greedy, nbest_time,
        nbest_date, nbest_text, layout_drawn, stub_grid, router_rows, coco_lines, yolo_files, failure_review, review_page, review_list, split_bernoulli, export_stream,
        export_time_summary, export_time_detail, time_three_way, amount_sanitize, amount_canon, date_sanitize, minutes_worked, alias_coalesce, json_shapes,
        row_col_infer, crop_path_parse, bucket_fields, nbest_rescore, local_choice, triage_conf, cer_exact_match, accuracy_report, confusion_topk,
        eval_per_column, labels_latest, labels_gold, labels_latest_stream, missing_images, grid_row_bin, row_histogram, grid_assign, page_json,
        layout_offsets, coco_annotations, coco_images, yolo_lines, crop_manifest, bbox_any, dataset_lint, split_exact, failure_reasons,
        failure_texts, union_inputs, text_clean, label_import, synth_crops, events_by_hour,
    )
}
