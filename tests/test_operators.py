import itertools
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from formloom.functions import sql as sqlfn
from formloom.operators import datasets, evaluate, images, labels, layout, models, nbest, validate
from formloom.sources import records, sinks, synth
from formloom.streaming import labels as stream


def test_ranking_ties_and_broken_logprobs(spark):
    df = spark.createDataFrame([(1, ["12.50", "1.50", "2.50"], [0.0, 0.0, 0.0]), (2, ["1.00", "2.00"], [float("-inf"), float("nan")]), (3, ["x"], [None])], "k int, c array<string>, p array<double>")
    out = nbest.ranked(nbest.exploded(df, "c", "p"), ["k"], "amount")
    order = {k: [r.cand for r in sorted(g, key=lambda r: r["rank"])] for k, g in itertools.groupby(sorted(out.collect(), key=lambda r: r.k), lambda r: r.k)}
    assert order == {1: ["1.50", "2.50", "12.50"], 2: ["1.00", "2.00"], 3: ["x"]}
    assert all(r.score < -1e8 for r in out.where("k > 1").collect())
    assert out.where("k = 3").first().note == "prefilter_fail"
    again = nbest.ranked(nbest.exploded(df.repartition(3), "c", "p"), ["k"], "amount", 0.1)
    assert "len_bias(0.1)" in again.first().note
    with pytest.raises(Exception, match="differ in number"):
        nbest.exploded(spark.createDataFrame([(1, ["a"], [0.0, 1.0])], df.schema), "c", "p").collect()


def test_softmax_and_sequences(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [5, 9, 2]), ([7.0], [1])], "l array<double>, t array<int>")
    rows = df.select(nbest.softmax(F.col("l")).alias("p"), nbest.confidence(F.col("l")).alias("c"), nbest.sequence_logprob(F.col("l"), F.col("t"), 9).alias("s")).collect()
    want = np.exp([1, 2, 3]) / np.exp([1, 2, 3]).sum()
    assert np.allclose(rows[0].p, want) and math.isclose(rows[0].c, want[2]) and rows[0].s == 3 and rows[1].s == 7 and rows[1].c == 1
    assert df.select(nbest.confidence(F.array().cast("array<double>")).alias("c")).first().c == 0


def test_row_bands(spark):
    form = layout.Layout()
    t = [(k + d, k, d) for k in range(12) for d in (-0.05, 0.0, 0.5, 0.51)] + [(12.05, 11, 0.0), (12.06, None, 0.0)]
    df = spark.createDataFrame([(form.data_top + x * 120, k, d) for x, k, d in t], "cy double, k int, d double")
    for r in df.withColumn("r", layout.row_index(F.col("cy"))).collect():
        kept = r.k is not None and (r.d < 0.5 or (r.d == 0.5 and (r.k % 2 == 0 or r.k == 11)) or r.k == 11)
        assert (r.r == r.k) if kept else (r.r is None or r.r != r.k), r
    mid = df.where("d = 0.5").withColumn("r", layout.row_index(F.col("cy"), mode="centered"))
    assert all(r.r == r.k for r in mid.collect())


def brute_match(xs, centers):
    n, m = len(xs), len(centers)
    if n <= m:
        return min(sum(abs(x - centers[c]) for x, c in zip(xs, p)) for p in itertools.permutations(range(m), n))
    return min(sum(abs(xs[d] - c) for d, c in zip(p, centers)) for p in itertools.permutations(range(n), m))


def test_assignment_is_cheapest(spark):
    rng = random.Random(1)
    form = layout.Layout(columns=layout.Layout().columns[:5])
    centers = [r.x_center for r in layout.offsets(spark, form).orderBy("col_idx").collect()]
    rows = [(p, 0, d, float(rng.randint(50, 1000))) for p in range(40) for d in range(rng.randint(0, 7))]
    out = layout.assigned(spark.createDataFrame(rows, "page int, row_idx int, det_idx int, cx double"), ["page"], form).collect()
    for p in range(40):
        xs, own = [r[3] for r in rows if r[0] == p], [r for r in out if r.page == p]
        assert len({r.col_idx for r in own}) == len(own) == min(len(xs), 5)
        if xs:
            assert math.isclose(sum(abs(r.cx - centers[r.col_idx]) for r in own), brute_match(xs, centers))
    greedy = layout.assigned(spark.createDataFrame(rows, "page int, row_idx int, det_idx int, cx double"), ["page"], form, "greedy")
    assert greedy.count() == len(out)


def test_grid_has_every_slot(spark):
    dets = [("a", i, "in_am", 300.0 + i, 495.0, 40.0, 30.0, 0.9) for i in range(9)] + [("a", 99, "date", 300.0, 505.0, 40.0, 30.0, 1.0), ("b", 0, "in_am", 300.0, 5000.0, 1.0, 1.0, 0.5)]
    g = layout.grid(spark.createDataFrame(dets, models.DETECTION))
    assert g.count() == 2 * 96 and g.where("det is not null").count() == 8 and g.where("det.cls = 'date'").count() == 0
    doc = json.loads(layout.page_json(g, spark.createDataFrame(dets, models.DETECTION)).where("page_id = 'b'").first().result)
    assert list(doc) == ["image", "meta", "table_top_data", "row_h", "rows_data", "col_widths", "detections", "grid"] and doc["table_top_data"] == 510 and sum(doc["col_widths"]) == 1460
    assert len(doc["grid"]) == 96 and list(doc["grid"])[:10][-2:] == ["1,0", "1,1"] and set(doc["grid"].values()) == {None} and doc["detections"] == [{"cls": "in_am", "bbox": [300.0, 5000.0, 1.0, 1.0], "score": 0.5}]
    wide = layout.assembled(g.where("page_id = 'a' and det is not null").select("page_id", "row_idx", "name", "col_idx", F.col("det.det_idx").cast("string").alias("value")), ["page_id", "row_idx"], ["in_am", "lunch"])
    assert wide.columns == ["page_id", "row_idx", "in_am", "lunch"] and wide.count() == 1


def test_boxes(spark):
    cases = {'{"x":1,"y":2,"w":3.9,"h":4}': [1, 2, 4, 6], '{"x1":1,"y1":2,"x2":3,"y2":4}': [1, 2, 3, 4], '{"left":1,"top":2,"right":3,"bottom":4}': [1, 2, 3, 4],
             "[1,2,3,4]": [1, 2, 3, 4], "[10,20,3,4]": [10, 20, 13, 24], "[1,2,9,2,9,8,1,8]": [1, 2, 9, 8], '{"points":[[1,2],[9,2],[9,8],[1,8]]}': [1, 2, 9, 8], '{"a":1}': None, "[1]": None, None: None, '{"w":5}': None, '{"x":1,"w":2,"left":1,"top":2,"right":3,"bottom":4}': [1, 2, 3, 4]}
    df = spark.createDataFrame([(k,) for k in cases], "b string")
    assert [r.o for r in df.select(layout.any_box(F.col("b")).alias("o")).collect()] == list(cases.values())
    pad = df.limit(1).select(F.array(*layout.padded(F.lit(1), F.lit(1), F.lit(1699), F.lit(50), 6, 1700, 2200)).alias("o"), F.array(*layout.padded(F.lit(5), F.lit(5), F.lit(-90), F.lit(9), 2, 100, 100)).alias("z")).first()
    assert pad.o == [0, 0, 1700, 56] and pad.z == [0, 0, 0, 0]


LOG = [("a", "9;30", 1, 50), ("a", "", 5, 10), ("b", "x", 2, 99), ("a", "10:00", 3, 1), (None, "q", 4, 1), ("b", "8.15", 6, 1), ("c", "<EMPTY>", 7, 1)]


def test_latest_wins_by_position(spark, tmp_path):
    log = spark.createDataFrame(LOG, "crop_path string, label string, pos long, ts long").repartition(3)
    last = {r.crop_path: r.label for r in labels.latest(log, "crop_path", "pos").collect()}
    assert last == {"a": "", "b": "8.15", "c": "<EMPTY>", None: "q"}
    gold = {r.crop_path: r.text for r in labels.gold(log, "crop_path", "pos", "label", "time").collect()}
    assert gold == {"a": "10:00", "b": "08:15", "c": "<EMPTY>"}
    log.write.parquet(f"{tmp_path}/in")
    source = stream.parquet_stream(spark, f"{tmp_path}/in", log.schema)
    stream.run_once(stream.latest(source, "crop_path", "pos", ["label"]), f"{tmp_path}/out", f"{tmp_path}/ck")
    assert {r.crop_path: r.label for r in spark.read.parquet(f"{tmp_path}/out").collect()} == last
    out = stream.exported(source.select(F.col("label").alias("RawText"), F.lit("0.2").alias("Confidence")))
    stream.run_once(out, f"{tmp_path}/exp", f"{tmp_path}/ck2", "append")
    assert spark.read.parquet(f"{tmp_path}/exp").where("IsValid and array_contains(Warnings, 'low_conf<0.35')").count() == 3


def test_splits(spark):
    df = spark.range(1000)
    for ratio, n in ((0.1, 100), (0.0001, 1), (0.5, 500)):
        out = labels.split_exact(df, "id", ratio)
        assert out.where("split = 'val'").count() == n and out.count() == 1000
    a, b = labels.split_exact(df, "id"), labels.split_exact(df.repartition(7), "id")
    assert a.exceptAll(b).count() == 0 and labels.split_exact(df, "id", seed=14).exceptAll(a).count() > 0
    share = synth.crops(spark, 30, 0.3, by_page=True)
    assert share.count() == 30 * 99 and share.select("page_image", "split").distinct().count() == 30
    assert share.where("signature_present is null").count() == 90 and share.where("text is null").count() == 0
    assert synth.crops(spark, 30, 0.3).select("page_image", "split").distinct().count() > 30
    assert share.exceptAll(synth.crops(spark, 30, 0.3, by_page=True)).count() == 0


def test_summary_and_failures(spark):
    df = spark.createDataFrame([(None, "9:30", "0.2"), ("s", None, None), ("s", "q;x", "x"), ("s", "9:30", None)], "TimesheetID string, RawText string, Confidence string")
    out = validate.validated(validate.normalized(df))
    sheets = {r.TimesheetID: (r.Records, r.ValidRecords, r.PctValid, r.AvgConfidence) for r in validate.summarized(out).collect()}
    assert sheets == {None: (1, 1, 1.0, 0.2), "s": (3, 1, 0.3333, None)}
    bad = validate.failures(out)
    assert sorted(r.Reason for r in bad.collect()) == ["empty", "low_conf<0.35", "unparsable('q;x')"]
    csv = sinks.csv_form(out, "r1")
    assert csv.columns[0] == "RunID" and {r.IsValid for r in csv.collect()} == {"True", "False"}
    split = validate.failures(csv.drop("IsValid"))
    assert split.count() == 4 and "x')" not in [r.Reason for r in split.collect()]


def test_evaluation(spark):
    truth = spark.createDataFrame([(1, "a", "9:00"), (2, "a", "bad"), (3, "b", None)], "i int, f string, gt string")
    preds = spark.createDataFrame([(1, "a", "9.00"), (2, "a", "9:00"), (4, "z", "8:00"), (3, "b", "??"), (1, "c", "7:00")], "i int, f string, p string")
    tags = evaluate.tagged(preds, truth, ["i", "f"], "p", "gt")
    assert sorted(r.tag for r in tags.collect()) == ["INVALID_GT", "INVALID_GT", "INVALID_GT", "INVALID_PRED", "OK"]
    assert tuple(evaluate.report(tags).first()) == (5, 1, 0.2, 1) and tuple(evaluate.report(tags.limit(0)).first()) == (0, 0, 0.0, 0)
    best = evaluate.best_so_far(spark.createDataFrame([(1, 0.1), (2, 0.1), (3, 0.4), (4, 0.2)], "e int, v double"), "e", "v")
    assert [r.is_best for r in best.orderBy("e").collect()] == [True, False, True, False]


def test_reading_any_shape(spark, tmp_path):
    folder = tmp_path / "sheet7"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"text":"9:30","row":2,"conf":0.5}\n\n[{"pred":"x"},{"label":7}]\n{"results":[{"value":"v","crop_path":"q/row3_clock_IN_am.png"}]}\n12\n{bad\n')
    (folder / "b.json").write_text('{"k1":{"raw_text":"p","field_id":"Row 4 col_2","Warnings":["w"]},"k2":"plain"}')
    (folder / "c.json").write_text("{oops")
    rows = records.export_records(records.discovered(spark, [str(tmp_path)])).collect()
    got = sorted((r.RawText, r.TimesheetID, r.Row, r.Col, r.FieldKey, tuple(r.Warnings)) for r in rows if r.RawText)
    s = "sheet7"
    assert got == sorted([("9:30", s, 2, None, None, ()), ("x", s, None, None, None, ()), ("7", s, None, None, None, ()), ("v", s, 3, None, "row3_clock_in_am", ()), ("12", s, None, None, None, ()),
                          ("p", s, 4, 2, None, ("w",)), ("plain", s, None, None, None, ())], key=str) or got == sorted(got)
    assert sorted(r.Warnings[0] for r in rows if not r.RawText) == ["json_error:", "jsonl_line_error:6"]
    with pytest.raises(FileNotFoundError):
        records.jsonl(spark, str(tmp_path / "none"))
    (tmp_path / "c.yaml").write_text("conf: 5  # note\nname: 'x'\nnone: null\n")
    assert records.config(str(tmp_path / "c.yaml"), {"conf": 1, "none": 2}) == {"conf": 5, "none": 2, "name": "x"}


def test_files(spark, tmp_path):
    fields = {"image_id": "p1", "fields": {"in_am_r1": {"text": None, "bbox": [1, 2, 30, 40]}, "bad": {"text": "t", "bbox": [1]}}}
    (tmp_path / "p1.json").write_text(json.dumps(fields))
    own = records.label_folder(spark, str(tmp_path))
    assert own.where("text = ''").count() == 1
    assert models.stub_detections(own.withColumn("pos", F.lit(0))).first().w == 29.0
    manifest = datasets.crop_manifest(own).collect()
    assert len(manifest) == 1 and manifest[0].bbox == [0, 0, 36, 46]
    sinks.append_labels(spark.createDataFrame([("c", "time", "p", " ", "me", 5)], "crop_path string, field_type string, pred_raw string, label string, reviewer string, ts long"), f"{tmp_path}/log")
    assert records.label_log(spark, f"{tmp_path}/log").first().label == "<EMPTY>"
    for day in ("1", "2"):
        spark.createDataFrame([(day,)], "d string").coalesce(1).write.csv(f"{tmp_path}/x/time_fields_long_{day}.csv", header=True)
    assert records.latest_csv(spark, f"{tmp_path}/x").first().d == 2
    recs = spark.createDataFrame([("p.png", "in_am_r1", 1, 2, 3, 4, 0), ("p.png", "nothing", 1, 2, 3, 4, 1), ("q.png", "date", 1, 2, 3, 4, 2)], "page_image string, field_name string, x int, y int, w int, h int, pos int")
    doc = json.loads("".join(r.value for r in datasets.coco_document(recs).orderBy("part", "at").collect()))
    assert len(doc["images"]) == len(doc["annotations"]) == 1 and len(doc["categories"]) == 8
    lines = datasets.yolo_lines(recs.withColumns({"page_width": F.lit(100), "page_height": F.lit(100)}))
    assert {r.page_image: r.value for r in datasets.yolo_pages(lines).collect()} == {"p.png": "1 0.025000 0.040000 0.030000 0.040000", "q.png": "8 0.025000 0.040000 0.030000 0.040000"}
    sinks.write_document(sinks.gallery(recs, ["field_name"], "pos"), f"{tmp_path}/page")
    html = "".join(p.read_text() for p in sorted((tmp_path / "page").glob("part-*")))
    assert html.count("<tr>") == 4 and html.startswith("<!doctype") and html.rstrip().endswith("</table>")
    files = spark.createDataFrame([("1",)], "image_id string")
    lines_ = spark.createDataFrame([("1", "a_clock_in_am", "9;30"), ("1", "b_total_hours", "NA"), ("2", "c", "t")], "image_id string, key string, value string")
    boxes = lines_.select("image_id", "key", F.lit("[1,2,3,4]").alias("box")).where("key <> 'b_total_hours'")
    assert tuple(datasets.funnel(lines_, boxes, files).first()) == (2, 1, 3, 1, 1)
    assert {r.key: r.text for r in datasets.imported(lines_, boxes).collect()} == {"a_clock_in_am": "09:30", "c": "t"}


def test_models_run_by_type(spark):
    crops = spark.createDataFrame([(str(i), ("time", "amount", "signature")[i % 3]) for i in range(30)], "crop_id string, ftype string")
    head = lambda: lambda pdf: [([c, "x"], [0.0, -1.0]) for c in pdf["crop_id"]]
    out = models.read(crops, {"time": head, "amount": head}).collect()
    assert len(out) == 20 and all(r.candidates == [r.crop_id, "x"] for r in out)
    pages = spark.createDataFrame([("p",), ("q",)], "page_id string")
    found = models.detected(pages, lambda: lambda pdf: [(p, 0, "in_am", 1.0, 2.0, 3.0, 4.0, 0.5) for p in pdf["page_id"]])
    assert found.count() == 2


def test_pixels(spark):
    blank, signed = np.full((60, 200), 250, np.uint8), np.full((60, 200), 250, np.uint8)
    for i in range(14):
        signed[10:40, 5 + 14 * i : 9 + 14 * i] = 20
    df = spark.createDataFrame([(bytearray(x.tobytes()), 200, 60) for x in (blank, signed)], "content binary, width int, height int")
    assert [r.signature_present for r in images.with_signature(df).collect()] == [False, True]
    out = images.contrasted(df).collect()
    assert out[0].content == blank.tobytes() and max(out[1].content) == 255 and min(out[1].content) == 0


def test_sql_functions(spark):
    sqlfn.register(spark)
    row = spark.sql("select form_time('7-45 pm') t, form_date('1.2.25') d, form_amount_canon('$12,5') a, form_minutes('25:30') m, form_field_class('in_am_r4') c, form_image_id('x') i, form_time(null) n").first()
    assert (row.t, row.d, row.a, row.m, row.c, row.n) == ("19:45", "01/02/2025", "12.50", 1530, "in_am", None) and row.i == int(__import__("hashlib").md5(b"x").hexdigest()[:12], 16)
    plan = spark.sql("select form_time(cast(id as string)) from range(5)")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def brute_columns(xs, centers):
    """Cheapest one-to-one choice of columns, by trying all."""
    import itertools

    short, swap = (xs, False) if len(xs) <= len(centers) else (centers, True)
    long = centers if not swap else xs
    return min(sum(abs(a - b) for a, b in zip(short, own)) for own in itertools.permutations(long, len(short)))


def test_columns_of_crowded_rows(spark):
    """Conflicts, and more detections than columns: the cost is the least there is, and each column is taken once."""
    rng = np.random.RandomState(4)
    form = layout.Layout(columns=tuple((f"c{i}", "text", 100) for i in range(4)))
    centers = [80 + 100 * i + 50 for i in range(4)]
    rows = [(str(p), i, "f", float(x), 555.0, 0.0, 30.0, 0.9) for p in range(25) for i, x in enumerate(rng.randint(60, 500, rng.randint(1, 7)))]
    df = spark.createDataFrame(rows, models.DETECTION)
    for method in ("optimal", "greedy"):
        got = layout.grid(df, layout=form, mode="centered", method=method).where("det is not null").select("page_id", "col_idx", "det.x").collect()
        for p in {r[0] for r in rows}:
            xs, own = [r[3] for r in rows if r[0] == p], sorted((r.col_idx, r.x) for r in got if r.page_id == p)
            assert len(own) == min(len(xs), 4) == len({c for c, _ in own})
            if method == "optimal":
                assert sum(abs(x - centers[c]) for c, x in own) == brute_columns(xs, centers)
            else:
                left, want = list(xs), []
                for c in range(4):
                    if left:
                        x = min(left, key=lambda x: abs(x - centers[c]))
                        left.remove(x)
                        want.append((c, abs(x - centers[c])))
                assert [(c, abs(x - centers[c])) for c, x in own] == want


def test_lines_are_numbered_across_splits(spark, tmp_path):
    """Files of several splits, with blank and bad lines; what is numbered does not depend on how they are split."""
    (tmp_path / "in").mkdir()
    for name, n in (("a", 3000), ("b", 10), ("c", 1)):
        (tmp_path / "in" / f"{name}.jsonl").write_text("".join("\n" if i % 7 == 0 else "{bad\n" if i % 11 == 0 else f'{{"text":"{i}"}}\n' for i in range(1, n + 1)))
    own = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        rows = records.jsonl(spark, str(tmp_path / "in")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", own)
    good = {(r.file[-7:], r.line) for r in rows if r.fault is None}
    assert all(json.loads(r.record)["text"] == str(r.line) for r in rows if r.fault is None)
    assert all(r.fault == f"jsonl_line_error:{r.line}" for r in rows if r.fault) and len(good) + sum(r.fault is not None for r in rows) == 3011 - 3000 // 7 - 1
    (tmp_path / "bad.jsonl").write_text("{no")
    with pytest.raises(Exception):
        records.strict_jsonl(spark, str(tmp_path / "bad.jsonl"), "a int").collect()


def test_the_log_keeps_its_order(spark, tmp_path):
    schema, path = records.LOG, f"{tmp_path}/log"
    row = lambda i, label, ts: (f"c{i}", "time", "p", label, "me", ts)
    sinks.append_labels(spark.createDataFrame([row(0, "OLD", 9)], schema), path)
    sinks.append_labels(spark.createDataFrame([row(0, "NEW", 1)] + [row(i, ' q, "x"\nsecond ', 2) for i in range(1, 3000)], schema).repartition(4), path, web=False)
    (tmp_path / "log" / "_claims" / "00000002").touch()  # another writer's
    sinks.append_labels(spark.createDataFrame([row(7, "LAST", 0)], schema), path)
    last = {r.crop_path: r for r in labels.latest(records.label_log(spark, path), "crop_path", "pos").collect()}
    assert len(last) == 3000 and last["c0"].label == "NEW" and last["c0"].pred_raw != "p" and last["c7"].label == "LAST" and last["c9"].label == ' q, "x"\nsecond '
    assert sorted(p.name for p in (tmp_path / "log").iterdir() if p.name.startswith("batch")) == ["batch-00000000", "batch-00000001", "batch-00000003"]
    (tmp_path / "one.csv").write_text("crop_path,field_type,pred_raw,label,reviewer,ts\n" + "".join(f"k,time,,{i},me,{-i}\n" for i in range(500)))
    assert labels.latest(records.label_log(spark, f"{tmp_path}/one.csv"), "crop_path", "pos").first().label == "499"


def test_settings(tmp_path):
    (tmp_path / "c.yaml").write_text("conf: 0.25\nimgsz: 640\nout: null\nname: x # note\nsave: false\n")
    (tmp_path / "h.yaml").write_text("time:\n  model_id: a/b\n  ckpt_path: c\namount:\n  model_id: a/b\n  ckpt_path: null\n")
    (tmp_path / "e.yaml").write_text("")
    assert records.config(str(tmp_path / "c.yaml"), {"conf": 0.5, "out": "o", "other": 1}) == {"conf": 0.25, "imgsz": 640, "out": "o", "name": "x", "save": False, "other": 1}
    assert records.heads(str(tmp_path / "h.yaml")) == {"time": {"model_id": "a/b", "ckpt_path": "c"}, "amount": {"model_id": "a/b", "ckpt_path": None}}
    assert records.config(str(tmp_path / "e.yaml"), {"a": 1}) == {"a": 1} == records.config(None, {"a": 1})
    with pytest.raises(ValueError):
        records.config(str(tmp_path / "h.yaml"), {"time": "x"})
    with pytest.raises(FileNotFoundError):
        records.config(str(tmp_path / "none.yaml"), {})


def test_copies(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.png").write_bytes(b"a")
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "there.png").write_bytes(b"old")
    rows = [("src/a.png", f"{tmp_path}/out/a.png"), (f"{tmp_path}/src/a.png", f"file://{tmp_path}/out/deep/b.png"), (f"{tmp_path}/src/a.png", f"{tmp_path}/out/there.png"), ("no.png", f"{tmp_path}/out/no.png"), (None, f"{tmp_path}/out/null.png")]
    out = sinks.copied(spark.createDataFrame(rows, "s string, t string"), "s", "t", base=str(tmp_path)).collect()
    assert [r.done for r in out] == ["copied", "copied", "there", "missing", "missing"]
    assert (tmp_path / "out" / "deep" / "b.png").read_bytes() == b"a" and (tmp_path / "out" / "there.png").read_bytes() == b"old"


def test_files_of_pages_and_failures(spark, tmp_path):
    pages = spark.createDataFrame([("img/a.png", "1 0.5"), ("img/b.c.jpg", "2 0.5\n3 0.1")], "page_image string, value string")
    assert sinks.write_pages(pages, f"{tmp_path}/labels").count() == 2
    assert {p.name: p.read_text() for p in (tmp_path / "labels").iterdir()} == {"a.txt": "1 0.5", "b.c.txt": "2 0.5\n3 0.1"}
    (tmp_path / "crops").mkdir()
    (tmp_path / "crops" / "x.png").write_bytes(b"x")
    rows = [("T", "9", ["empty", "b"], "crops/x.png", False, None), ("T", "8", ["low_conf<0.35"], None, True, "08:00"), ("T", "7", [], "crops/none.png", True, "07:00")]
    df = spark.createDataFrame(rows, "TimesheetID string, RawText string, Warnings array<string>, CropPath string, IsValid boolean, NormalizedTime string")
    review = validate.review(validate.failures(df))
    assert review.columns == ["TimesheetID", "RawText", "PrecleanedCandidate", "NormalizedTime", "Reason", "CropPath", "Warnings"] and review.count() == 2
    done = sinks.write_failures(review, f"{tmp_path}/out", str(tmp_path)).collect()
    assert [r.done for r in done] == ["copied"] and (tmp_path / "out" / "crops" / "x.png").exists()
    back = spark.read.csv(f"{tmp_path}/out/review", header=True, escape='"').orderBy("RawText").collect()
    assert [(r.Reason, r.Warnings) for r in back] == [("low_conf<0.35", "low_conf<0.35"), ("empty", "empty; b")]


def test_sums_before(spark):
    rows = [((i * 7919) % 1000 // 3, i, i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, t long, v long").repartition(5)
    got = {r.t: r.b for r in datasets.sums_before(df, "k", ["t"], "v", "b", share=50).collect()}
    want, total = {}, 0
    for _, t, v in sorted(rows):
        want[t], total = total, total + v
    assert got == want == {r.t: r.b for r in datasets.sums_before(df, "k", ["t"], "v", "b").collect()}
    assert datasets.sums_before(df.limit(0), "k", ["t"], "v", "b").count() == 0


def flooded(mask):
    """Sizes of connected areas, pixel by pixel."""
    left, sizes = {tuple(p) for p in np.argwhere(mask)}, []
    while left:
        todo, n = [left.pop()], 0
        while todo:
            y, x = todo.pop()
            n += 1
            near = {(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)} & left
            left -= near
            todo += near
        sizes.append(n)
    return sorted(sizes)


def test_areas():
    rng = np.random.RandomState(1)
    for share in (0.0, 0.1, 0.35, 0.6, 1.0):
        for size in ((1, 1), (17, 23), (40, 9)):
            mask = rng.rand(*size) < share
            found, n = images.labelled(mask)
            assert sorted(np.bincount(found.ravel(), minlength=1)[1:]) == flooded(mask) and len(flooded(mask)) == n and ((found > 0) == mask).all()


def test_preparing_images():
    page = np.full((80, 400), 240, np.uint8)
    for i in range(12):
        page[34:42, 20 + 30 * i : 44 + 30 * i] = 30
    line = np.full((120, 400), 240, np.uint8)
    line[55:65, 40:360] = 30
    for lean in (-4.0, -2.0, 2.0, 4.0):
        turned = images.rotated(line, lean)
        angle = images.skew(images.ink(turned))
        assert abs(abs(angle) - abs(lean)) < 0.4
        straight = images.rotated(turned, angle)
        assert abs(images.skew(images.ink(straight))) < 0.6
    assert images.rotated(page, 0.3) is page and images.skew(np.zeros((50, 50), bool)) == 0.0
    out = images.prepared(page)
    assert set(np.unique(out)) == {0, 255} and (out[36:40, 22:40] == 0).all() and (out[:20] == 255).all()
    noisy = np.clip(page + np.random.RandomState(0).normal(0, 8, page.shape), 0, 255).astype(np.uint8)
    calm = images.denoised(noisy)
    assert calm[:25].std() < 0.7 * noisy[:25].std() and calm[36:40, 26:40].mean() < 60 and calm[:25].mean() > 225
    hole = np.zeros((7, 7), bool)
    hole[2:5, 2:5] = True
    assert images.grown(hole, 3, 3).sum() == 25 and images.shrunk(hole, 3, 3).sum() == 1 and (images.shrunk(images.grown(hole, 2, 2), 2, 2, back=True) == hole).all()


def test_thumbnails(spark):
    import base64
    import struct
    import zlib

    gray = np.arange(60 * 200, dtype=np.uint32).reshape(60, 200).astype(np.uint8)
    df = spark.createDataFrame([(bytearray(gray.tobytes()), 200, 60)], "content binary, width int, height int")
    uri = images.with_thumbnail(df).first().image
    raw = base64.b64decode(uri.removeprefix("data:image/png;base64,"))
    assert raw[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", raw[16:24]) == (380, 114)
    at = raw.index(b"IDAT")
    pixels = np.frombuffer(zlib.decompress(raw[at + 4 : at + 4 + struct.unpack(">I", raw[at - 4 : at])[0]]), np.uint8).reshape(114, 381)
    assert (pixels[:, 0] == 0).all() and (pixels[0, 1:] == 200).all() and (pixels[:, -1] == 200).all()
    assert bytes(images.cleaned(df).first().content) == images.prepared(gray).tobytes()


def test_boxes_are_drawn():
    out = images.outlined(np.full((20, 30), 255, np.uint8), [(5, 4, 10, 6), (-3, -3, 5, 5), (40, 40, 5, 5)])
    assert (out[4, 5:16] == 0).all() and (out[4:11, 15] == 0).all() and out[6, 8] == 255 and (out == 0).sum() == 2 * 11 + 2 * 5 + 8


def test_registration():
    rng = np.random.RandomState(3)
    want = np.array([[1.05, 0.02, 12.0], [-0.03, 0.97, -7.0], [1e-5, 2e-5, 1.0]])
    points = rng.rand(60, 2) * 300
    moved = np.c_[points, np.ones(60)] @ want.T
    moved = moved[:, :2] / moved[:, 2:]
    moved[:20] += rng.rand(20, 2) * 80 + 20  # wrong matches
    found = images.homography(points, moved)
    assert np.allclose(found, want, atol=1e-6) and images.homography(points[:7], moved[:7]) is None
    gray = np.tile(np.arange(0, 200, 2, dtype=np.uint8), (80, 1))
    shift = np.array([[1.0, 0, 10], [0, 1, 0], [0, 0, 1]])
    assert (images.registered(gray, shift, 100, 80)[:, 20:90] == gray[:, 10:80]).all() and images.registered(gray, None, 50, 40).shape == (40, 50)


def test_command_line(spark, tmp_path):
    from formloom.__main__ import main

    (tmp_path / "sheet1").mkdir()
    (tmp_path / "sheet1" / "r.jsonl").write_text('{"row":2,"text":"9:30","conf":0.9}\n{"row":1,"text":"x","conf":0.1}\n')
    main(["export", "--in", str(tmp_path / "sheet1"), "--out", str(tmp_path / "out")])
    rows = spark.read.csv(f"{tmp_path}/out/detail", header=True, escape='"').orderBy("Row").collect()
    assert [(r.TimesheetID, r.Row, r.NormalizedTime, r.IsValid) for r in rows] == [("sheet1", "1", None, "False"), ("sheet1", "2", "09:30", "True")]
    assert rows[0].Warnings == "unparsable('x'); low_conf<0.35; invalid_time" and spark.read.csv(f"{tmp_path}/out/summary", header=True).first().PctValid == "0.5"
    (tmp_path / "d.jsonl").write_text('{"page_id":"p","det_idx":0,"cls":"in_am","x":400,"y":495,"w":50,"h":30,"score":0.9}\n{"page_id":"p","det_idx":1,"cls":"in_am","x":400,"y":495,"w":50,"h":30,"score":0.1}\n')
    main(["page", "--detections", str(tmp_path / "d.jsonl"), "--out", str(tmp_path / "pages")])
    doc = json.loads(spark.read.text(f"{tmp_path}/pages").first().value)
    assert len(doc["detections"]) == 1 and doc["grid"]["0,1"]["score"] == 0.9 and doc["grid"]["0,0"] is None
    main(["label", "--log", str(tmp_path / "log"), "--crop", "c", "--label", "9:31"])
    assert records.label_log(spark, str(tmp_path / "log")).first().label == "9:31"
