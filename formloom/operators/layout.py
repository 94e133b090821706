"""Geometry: boxes, row bands and columns of a form, and the grid they make up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """A form of `rows` bands under `headers` header bands, which begin `gap` below the margin. columns: (name, type, width). The values are
    fixed ones of the form as it is read; forms that are drawn have DRAWN."""

    columns: tuple = (
        ("employee_name", "text", 260), ("in_am", "time", 170), ("out_am", "time", 170), ("lunch", "time", 140),
        ("in_pm", "time", 170), ("out_pm", "time", 170), ("total_hours", "amount", 170), ("signature", "text", 210),
    )
    left: int = 80
    top: int = 180
    gap: int = 90
    row_height: int = 120
    rows: int = 12
    headers: int = 2
    inset: int = 0

    @property
    def data_top(self) -> int:
        return self.top + self.gap + self.headers * self.row_height


#: Fixed values of drawn forms: a larger margin, one header band, and cells set in by so many pixels.
DRAWN = Layout(top=240, headers=1, inset=8)


def offsets(spark: SparkSession, layout: Layout = Layout()) -> DataFrame:
    """(col_idx, name, ftype, width, x0, x_center): a running sum of widths."""
    cols = spark.createDataFrame([(i, *c) for i, c in enumerate(layout.columns)], "col_idx int, name string, ftype string, width int")
    before = F.coalesce(F.sum("width").over(Window.orderBy("col_idx").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return cols.withColumn("x0", (before + layout.left).cast("int")).withColumn("x_center", F.floor(F.col("x0") + F.col("width") / 2).cast("int"))


def cells(spark: SparkSession, layout: Layout = Layout()) -> DataFrame:
    """Every (row_idx, col_idx) of the form with its slot (x0, y0, width, row height) and the box inside it (bx, by, bw, bh)."""
    rows = spark.range(layout.rows).select(F.col("id").cast("int").alias("row_idx"))
    y0 = (F.col("row_idx") * layout.row_height + layout.data_top).cast("int")
    slots = rows.crossJoin(F.broadcast(offsets(spark, layout))).withColumn("y0", y0)
    inside = {"bx": F.col("x0") + layout.inset, "by": y0 + layout.inset, "bw": F.col("width") - 2 * layout.inset, "bh": F.lit(layout.row_height - 2 * layout.inset)}
    return slots.withColumns(inside)


def row_index(cy: Column, layout: Layout = Layout(), mode: str = "tops", share: float = 0.55) -> Column:
    """The band of a centre, null if it is too far from the band's middle. tops: bands are taken by their upper edges, rounded half to
    even; centered: by their middles."""
    t = (cy - layout.data_top) / layout.row_height
    at = F.least(F.greatest(F.rint(t if mode == "tops" else t - 0.5), F.lit(0.0)), F.lit(layout.rows - 1.0))
    middle = (at + 0.5) * layout.row_height + layout.data_top
    return F.when(F.abs(cy - middle) <= share * layout.row_height, at.cast("int"))


def _matched(costs: list[list[float]]) -> list[tuple[int, int]]:
    """Cheapest one-to-one pairs of sorted detections (rows) and sorted columns: an optimal matching of points on a line keeps their order."""
    n, m = len(costs), len(costs[0])
    if n > m:
        return [(j, i) for i, j in _matched([[costs[i][j] for i in range(n)] for j in range(m)])]
    best = [[0.0] * (m + 1)] + [[float("inf")] * (m + 1) for _ in range(n)]
    for i in range(1, n + 1):
        for j in range(i, m + 1):
            best[i][j] = min(best[i][j - 1], best[i - 1][j - 1] + costs[i - 1][j - 1])
    pairs, i, j = [], n, m
    while i:
        if j > i and best[i][j - 1] <= best[i][j]:
            j -= 1
        else:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
    return pairs[::-1]


def _pairs(xs: list[float], order: list, centers: list[int], method: str) -> list[tuple[int, int]]:
    """(detection, column) pairs of one row of a form."""
    near = [min(range(len(centers)), key=lambda j: abs(x - centers[j])) for x in xs]
    if method == "optimal" and len(set(near)) == len(xs):  # all have their nearest column: nothing is cheaper
        return list(enumerate(near))
    by_x = sorted(range(len(xs)), key=lambda i: (xs[i], order[i]))
    if method == "optimal":
        return [(by_x[i], j) for i, j in _matched([[abs(xs[i] - c) for c in centers] for i in by_x])]
    pairs, left = [], set(by_x)
    for j, c in enumerate(centers):
        if left:
            i = min(left, key=lambda i: (abs(xs[i] - c), order[i]))
            left.discard(i)
            pairs.append((i, j))
    return pairs


def assigned(df: DataFrame, keys: list[str], layout: Layout = Layout(), method: str = "optimal") -> DataFrame:
    """Adds col_idx to detections (keys, row_idx, det_idx, cx); each column at most once a row, other detections are dropped. greedy:
    each column in turn takes the nearest detection left. Rows of forms are dealt by their keys and come sorted, batch by batch."""
    import itertools

    x0 = [layout.left, *itertools.accumulate((c[2] for c in layout.columns), initial=layout.left)][1:]
    centers = [int(x + c[2] / 2) for x, c in zip(x0, layout.columns)]
    group, names = [*keys, "row_idx"], [*df.columns, "col_idx"]

    def place(batches):
        import pyarrow as pa

        def solve(table, bounds):
            xs, order, kept, cols = table.column("cx").to_pylist(), table.column("det_idx").to_pylist(), [], []
            for lo, hi in bounds:
                for i, j in sorted(_pairs(xs[lo:hi], order[lo:hi], centers, method)):
                    kept.append(lo + i)
                    cols.append(j)
            out = table.take(pa.array(kept, pa.int64())).append_column("col_idx", pa.array(cols, pa.int32()))
            return out.select(names).combine_chunks().to_batches()

        held = None  # the last row of a form may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            own = list(zip(*(table.column(k).to_pylist() for k in group)))
            starts = [i for i in range(len(own)) if i == 0 or own[i] != own[i - 1]]
            if not starts:
                continue
            yield from solve(table, zip(starts[:-1], starts[1:]))
            held = table.slice(starts[-1])
        if held is not None:
            yield from solve(held, [(0, held.num_rows)])

    schema = df.withColumn("col_idx", F.lit(0)).schema
    return df.repartition(*group).sortWithinPartitions(*group, "cx", "det_idx").mapInArrow(place, schema)


def grid(df: DataFrame, page: str = "page_id", layout: Layout = Layout(), ignored: tuple = ("date",), mode: str = "tops", method: str = "optimal") -> DataFrame:
    """Detections (page, det_idx, cls, x, y, w, h, score) to one row a slot of each page; slots without detection are null."""
    own = df.where(~F.coalesce("cls", F.lit("")).isin(*ignored)).withColumn("cx", F.col("x") + F.col("w") / 2)
    own = own.withColumn("row_idx", row_index(F.col("y") + F.col("h") / 2, layout, mode)).where("row_idx is not null")
    placed = assigned(own, [page], layout, method).select(page, "row_idx", "col_idx", F.struct("det_idx", "cls", "x", "y", "w", "h", "score").alias("det"))
    slots = df.select(page).distinct().crossJoin(F.broadcast(cells(df.sparkSession, layout).select("row_idx", "col_idx", "name", "ftype")))
    return slots.join(placed, [page, "row_idx", "col_idx"], "left")


def row_histogram(df: DataFrame, cy: str, layout: Layout = Layout()) -> DataFrame:
    """Detections by band with the range of their centres; empty bands too."""
    hist = df.withColumn("row_idx", row_index(F.col(cy), layout)).where("row_idx is not null").groupBy("row_idx")
    hist = hist.agg(F.count("*").alias("n"), F.min(cy).alias("y_min"), F.max(cy).alias("y_max"))
    rows = df.sparkSession.range(layout.rows).select(F.col("id").cast("int").alias("row_idx"))
    return rows.join(hist, "row_idx", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


_DETECTION = "array<struct<cls:string,bbox:array<double>,score:double>>"


def _detection(d: Column) -> Column:
    return F.struct(d["cls"].alias("cls"), F.array(d["x"], d["y"], d["w"], d["h"]).alias("bbox"), d["score"].alias("score"))


def page_json(cells_: DataFrame, detections: DataFrame, page: str = "page_id", layout: Layout = Layout(), crop_version: str = "v1") -> DataFrame:
    """(page, result): a page's result as JSON: image, meta, the form's measures, all detections in order, and the grid keyed 'row,col' by row and
    column, null where a slot is empty. A page has as many slots as the form."""
    slot = F.struct("row_idx", "col_idx", F.when(F.col("det").isNotNull(), _detection(F.col("det"))).alias("det"))
    grids = cells_.groupBy(page).agg(F.sort_array(F.collect_list(slot)).alias("_slots"))
    rows = F.struct("det_idx", _detection(F.struct("cls", "x", "y", "w", "h", "score")).alias("det"))
    found = detections.groupBy(page).agg(F.transform(F.sort_array(F.collect_list(rows)), lambda x: x["det"]).alias("detections"))
    grid_ = F.map_from_entries(F.transform("_slots", lambda s: F.struct(F.concat_ws(",", s["row_idx"], s["col_idx"]), s["det"])))
    body = F.struct(
        F.col(page).cast("string").alias("image"), F.struct(F.lit(crop_version).alias("crop_version"), F.lit(layout.headers).alias("header_rows")).alias("meta"),
        F.lit(layout.data_top).alias("table_top_data"), F.lit(layout.row_height).alias("row_h"), F.lit(layout.rows).alias("rows_data"),
        F.array(*(F.lit(c[2]) for c in layout.columns)).alias("col_widths"), F.coalesce("detections", F.array().cast(_DETECTION)).alias("detections"), grid_.alias("grid"),
    )
    return grids.join(found, page, "left").select(page, F.to_json(body, {"ignoreNullFields": "false"}).alias("result"))


def assembled(values: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Wide rows from (keys, name, col_idx, value); of several values of a name the last column's holds."""
    return values.groupBy(*keys).pivot("name", names).agg(F.max_by("value", "col_idx"))


def padded(x1: Column, y1: Column, x2: Column, y2: Column, pad: int, width, height) -> list[Column]:
    """A crop with a margin, kept inside the page; zeros if nothing is left."""
    box = [F.greatest(x1 - pad, F.lit(0)), F.greatest(y1 - pad, F.lit(0)), F.least(x2 + pad, F.lit(width)), F.least(y2 + pad, F.lit(height))]
    good = (box[2] > box[0]) & (box[3] > box[1])
    return [F.when(good, c).otherwise(0).cast("int") for c in box]


def any_box(json: Column) -> Column:
    """array<int> x1, y1, x2, y2 from JSON: objects (x y w h; x1 y1 x2 y2; left top right bottom; points), four numbers (corners if the
    last two exceed the first two, else corner and size), or eight and more (corners of a polygon). Null if none of these."""
    at = lambda k: F.get_json_object(json, f"$.{k}").try_cast("double")
    whole = lambda keys: F.array_size(F.array_compact(F.array(*map(at, keys.split())))) == 4
    ints = lambda *cs: F.array(*(c.cast("int") for c in cs))
    points = F.coalesce(F.get_json_object(json, "$.points"), F.get_json_object(json, "$.polygon"))
    xy = F.filter(F.from_json(points, "array<array<double>>"), lambda p: F.size(p) == 2)
    flat = F.from_json(json, "array<double>")
    odd = lambda r: F.filter(flat, lambda _, i: i % 2 == r)
    four = [F.get(flat, F.lit(i)) for i in range(4)]
    corners = (four[2] > four[0]) & (four[3] > four[1])
    span = lambda xs, ys: ints(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))
    is_list = F.startswith(F.ltrim(json), F.lit("["))
    return (
        F.when(is_list & (F.size(flat) == 4), F.when(corners, ints(*four)).otherwise(ints(four[0], four[1], four[0] + four[2], four[1] + four[3])))
        .when(is_list & (F.size(flat) >= 8), span(odd(0), odd(1)))
        .when(whole("x y w h"), ints(at("x"), at("y"), at("x") + at("w"), at("y") + at("h")))
        .when(whole("x1 y1 x2 y2"), ints(at("x1"), at("y1"), at("x2"), at("y2")))
        .when(whole("left top right bottom"), ints(at("left"), at("top"), at("right"), at("bottom")))
        .when(F.size(xy) >= 4, span(F.transform(xy, lambda p: p[0]), F.transform(xy, lambda p: p[1])))
    )


def yolo_line(cid: Column, x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """Class and centre form relative to the page, six digits."""
    return F.format_string("%d %.6f %.6f %.6f %.6f", cid, (x + w / 2) / width, (y + h / 2) / height, w / width, h / height)
