import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from formloom.functions import text

TIMES = """9;30|09:30|09:30|09:30
7-45 AM|07:45|07:45|
12:00 am|00:00|00:00|00:00
12.05pm|12:05|12:05|12:05
1130pm||23:30|
24:00|||00:00
9:75|||09:59
13:00pm|13:00|13:00|25:00
9|||09:00
45|||21:00
9:3|||09:03
114.30.||14:30|
1/1.30.|||01:30
,09130|||09:30
(13.30.||13:30|13:30
0S:3O|||05:30
9:30Am|09:30|09:30|
09h00||09:00|09:00
1:000|||01:00"""
AMOUNTS = {
    ",093.45.": "93.45", "114.30.": "114.30", "166.52.": "166.52", ",093.45": "93.45", "114.23.": "114.23", "(150,000.": "-150000.00",
    "(200.02.": "-200.02", "(150.059.": "-150.06", "(118.18,": "-118.18", "$1,234.50": "1234.50", "—1,234.50": "-1234.50", "--123.45": "-123.45",
    "O0.50": "0.50", "12,34": "12.34", "1,234,56": None, "....": None, "(": None, "-": None, "(999,999.99)": "-999999.99",
    "9,999,999.00": "9999999.00", "0.125": "0.12", "(0.00)": "0.00", "(0.001)": "-0.00", "($5.00)": None, "": None, None: None,
}
DATES = {"1-2-25": "01/02/2025", "1.2.2025": "01/02/2025", "02/31/2024": "02/31/2024", "13/01/2024": None, "1/2/202": None, "10/03/1998": None, " 1/2/25 ": "01/02/2025", None: None}


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def col(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


def test_times(spark):
    rows = [line.split("|") for line in TIMES.splitlines()]
    df = frame(spark, [r[0] for r in rows])
    df = text.time_parsed(text.time_lenient(text.time_strict(df, "t", "a"), "t", "b"), "t", "c", "w")
    for k, name in enumerate("abc", 1):
        assert col(df, name) == [r[k] or None for r in rows]
    notes = dict(zip((r[0] for r in rows), col(df, "w")))
    assert notes["24:00"] == ["hour>23"] and notes["9:75"] == ["minutes>59"] and notes["9:30Am"] == ["unparsable('9:30Am')"] and notes["9"] == []
    assert col(text.time_parsed(frame(spark, [None]), "t", "c", "w"), "w") == [["empty"]]


@pytest.mark.parametrize("fn,cases", [(text.amount, AMOUNTS), (text.date, DATES)])
def test_goldens(spark, fn, cases):
    assert col(fn(frame(spark, list(cases)), "t", "o"), "o") == list(cases.values())


def test_no_python_and_small_plans(spark):
    df = frame(spark, ["9:30"])
    for fn in (text.amount, text.time_strict, text.time_lenient, text.date, text.canon_amount):
        df = fn(df, "t", fn.__name__)
    df = text.time_parsed(df, "t", "parsed", "w")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and len(plan) < 60_000


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("0123456789:.,-()$Oo apmAPM/h;", max_size=12), min_size=30, max_size=60))
def test_own_output_is_stable(spark, values):
    df = frame(spark, values)
    for fn in (text.amount, text.time_strict, text.date):
        once = fn(df, "t", "o")
        assert once.where("o is not null and o not like '-0.00'").transform(lambda d: fn(d, "o", "p")).where("not (o <=> p)").count() == 0


def test_small_functions(spark):
    df = spark.range(1)
    one = lambda c: df.select(c.alias("x")).first().x
    assert one(text.minutes(F.lit("25:30"))) == 1530 and one(text.from_minutes(F.lit(1530))) == "25:30" and one(text.from_minutes(F.lit(-30))) == "-1:30"
    assert [one(text.field_class(F.lit(x))) for x in ("in_am_r4", "date", "foo_rate_r1")] == ["in_am", "date", "foo"]
    assert one(text.hashed_name(F.lit("/a/b.c.png"))).startswith("b.c__") and one(text.hashed_name(F.lit("/a/.x"))).startswith(".x__")
    assert one(text.html_escaped(F.lit("<a&'\">"))) == "&lt;a&amp;&#x27;&quot;&gt;"
    a, b = text.crop_parts(F.lit("root\\img7\\time\\row1_clock_in_am.png"))
    assert one(a) == "img7" and one(b) == "row1_clock_in_am"
    assert one(text.merged(F.array(F.lit("b"), F.lit("a")), F.lit(None).cast("array<string>"), F.array(F.lit("a"), F.lit("c")))) == ["b", "a", "c"]
    rc = spark.createDataFrame([(None, 5, "Row-3 x", "p/row_9/COL 2")], "row int, col int, f string, p string")
    assert tuple(text.row_col(rc, "row", "col", "f", "p").first())[:2] == (3, 5)
    canon = frame(spark, ["1,234.5", "", ".", "007", "$12", ".5", "1.2.3"])
    assert col(text.canon_amount(canon, "t", "o"), "o") == ["1.23", "", "", "7.00", "12.00", "0.50", "1.23"]
