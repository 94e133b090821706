"""Normalizers of recognised text, as steps over DataFrames.

Each takes a DataFrame, an input column and the name of the result. Every intermediate is a column of its own, so no
expression is repeated in the branches of another and plans stay small. Nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Steps:
    """Adds numbered helper columns; `done` adds the results and drops the helpers. Results are generated, one row each: filters on them are then
    not pushed below the steps, where they would repeat every step in each of its uses."""

    def __init__(self, df: DataFrame, tag: str):
        self.df, self.tag, self.names = df, tag, []

    def put(self, value: Column) -> Column:
        name = f"__{self.tag}_{len(self.names)}"
        self.names.append(name)
        self.df = self.df.withColumn(name, value)
        return F.col(name)

    def done(self, **results: Column) -> DataFrame:
        helpers = set(self.names)
        names = [c for c in self.df.columns if c not in helpers]
        row = F.inline(F.array(F.struct(*(v.alias(n) for n, v in results.items()))))
        return self.df.select(*(c for c in names if c not in results), row).select(*names, *(n for n in results if n not in names))


#: All white space of Unicode.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
LETTERS = "apmAPM"


def has(c: Column, *parts: str) -> Column:
    """Whether any of the parts is in the text. Regular expressions run only where there is something for them to do."""
    found = [F.contains(c, F.lit(p)) for p in parts]
    for other in found[1:]:
        found[0] = found[0] | other
    return found[0]


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE))


def squeezed(c: Column) -> Column:
    """White space collapsed to single spaces and stripped; null counts as empty."""
    return F.regexp_replace(strip(F.translate(F.coalesce(c, F.lit("")), SPACE, " " * len(SPACE))), " {2,}", " ")


def before(c: Column, mark: str) -> Column:
    return F.substring_index(c, mark, 1)


def after(c: Column, mark: str) -> Column:
    return F.substring_index(c, mark, -1)


def count_of(c: Column, mark: str) -> Column:
    return F.length(c) - F.length(F.translate(c, mark, ""))


def two_digits(n: Column) -> Column:
    return F.when(n < 10, F.concat(F.lit("0"), n.cast("string"))).otherwise(n.cast("string"))


def amount(df: DataFrame, col: str, out: str) -> DataFrame:
    """Money as [-]d.dd, half-even; null where it is none."""
    s = Steps(df, out)
    kept = F.regexp_replace(F.translate(strip(F.col(col)), "Oo—–", "00--"), r"[^0-9().,\-$]+", "")
    kept = F.translate(kept, "()", "<>")
    text = s.put(F.ltrim(F.replace(F.replace(kept, F.lit(",,"), F.lit(",")), F.lit(".."), F.lit(".")), F.lit("$")))
    dotted = F.when(has(text, "."), F.translate(text, ",", ""))
    text = s.put(dotted.when(text.rlike(r",\d\d>?$"), F.translate(text, ",", ".")).otherwise(text))
    marked = F.endswith(text, F.lit(".")) | F.endswith(text, F.lit(","))
    text = s.put(F.translate(F.when(marked, F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text), ",", ""))
    bare = s.put(F.btrim(text, F.lit("<>")))
    minus = F.startswith(text, F.lit("<")) | F.endswith(text, F.lit(">")) | F.startswith(bare, F.lit("-"))
    digits = s.put(F.ltrim(bare, F.lit("-")))
    value = s.put(F.when(digits.rlike(r"^(\d+\.?\d*|\.\d+)$"), digits.try_cast("decimal(38,10)")))
    sign = F.when(minus & (value != 0), "-").otherwise("")
    return s.done(**{out: F.when(F.length(col) > 0, F.concat(sign, F.bround(value, 2).cast("decimal(30,2)").cast("string")))})


def canon_amount(df: DataFrame, col: str, out: str) -> DataFrame:
    """Amount text in the form that accuracy is measured on; empty where there are no digits."""
    s = Steps(df, out)
    text = s.put(F.regexp_replace(F.translate(strip(F.col(col)), ",", "."), r"[^0-9.]+", ""))
    whole = s.put(before(text, "."))
    part = F.translate(F.substr(text, F.length(whole) + 1), ".", "")
    number = s.put(F.ltrim(whole, F.lit("0")))
    return s.done(**{out: F.when(text.isin("", "."), "").otherwise(F.concat(F.when(number == "", "0").otherwise(number), F.lit("."), F.rpad(part, 2, "0")))})


def _day_hour(hour: Column, half: Column) -> Column:
    """An hour on the 24-hour clock; half: am, pm or empty. Afternoon hours from 12 on stay."""
    return F.when((half == "am") & (hour == 12), 0).when((half == "pm") & (hour < 12), hour + 12).otherwise(hour)


def _clock(hour: Column, minute: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), minute)


def time_strict(df: DataFrame, col: str, out: str) -> DataFrame:
    """HH:MM of a time that is written without noise, else null."""
    s = Steps(df, out)
    low = s.put(F.lower(F.col(col)))
    text = F.when(has(low, ".m"), F.regexp_replace(low, r"([ap])\.m\.?", "$1m")).otherwise(low)
    text = s.put(F.translate(text, ";,.-" + SPACE, "::::"))
    good = text.rlike(r"^[0-2]?\d:[0-5]\d(?:am|pm)?$")
    hour = s.put(F.when(good, _day_hour(before(text, ":").cast("int"), F.ltrim(after(text, ":"), F.lit("0123456789")))))
    return s.done(**{out: F.when(hour <= 23, _clock(hour, F.left(after(text, ":"), F.lit(2))))})


def date(df: DataFrame, col: str, out: str) -> DataFrame:
    """MM/DD/YYYY of a date with the month first, from 2000 to 2100; days are checked up to 31 only. Null stays null."""
    s = Steps(df, out)
    text = s.put(F.translate(strip(F.col(col)), "-.", "//"))
    text = s.put(F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{2,4}$"), text))
    month, day, year = (s.put(c.cast("int")) for c in (before(text, "/"), after(F.substring_index(text, "/", 2), "/"), after(text, "/")))
    year = s.put(F.when(year < 100, year + 2000).otherwise(year))
    good = month.between(1, 12) & day.between(1, 31) & year.between(2000, 2100)
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return s.done(**{out: F.when(good, F.concat(two(month), F.lit("/"), two(day), F.lit("/"), year.cast("string")))})


def time_lenient(df: DataFrame, col: str, out: str) -> DataFrame:
    """HH:MM of a time among recognition noise, else null."""
    s = Steps(df, out)
    given = s.put(strip(F.col(col)))
    half = F.when(has(given, "m", "M"), F.translate(F.lower(F.regexp_extract(given, r"[aApP] *[mM]", 0)), " ", "")).otherwise("")
    half = s.put(half)
    text = s.put(F.regexp_replace(F.translate(given, ".-/hH", ":::::"), r"[^0-9:apmAPM]+", ""))
    digits = s.put(F.translate(text, ":" + LETTERS, ""))
    colons = s.put(count_of(text, ":"))
    first = F.translate(before(text, ":"), LETTERS, "")
    many = F.concat(first, F.lit(":"), F.substr(digits, F.length(first) + 1))
    none = F.when(F.length(digits) >= 3, F.concat(F.substr(digits, F.lit(1), F.length(digits) - 2), F.lit(":"), F.right(digits, F.lit(2))))
    text = s.put(F.when(colons > 1, many).when(colons == 0, none).otherwise(text))
    text = s.put(F.when(text.rlike(r"^\D*\d{1,3}:\d{2}\D*$"), F.translate(text, LETTERS, "")))
    hour = before(text, ":")
    hour = s.put(F.when((F.length(hour) == 3) & F.startswith(hour, F.lit("1")), F.right(hour, F.lit(2))).otherwise(hour).cast("int"))
    hour = s.put(_day_hour(hour, half))
    repaired = s.put(F.when(hour.between(0, 23) & (after(text, ":").cast("int") <= 59), _clock(hour, after(text, ":"))))
    # What is left goes by the plain form: hour, mark, minute, half.
    plain = F.when(repaired.isNull(), F.regexp_extract(F.col(col), r"^\s*(\d{1,2}[:hH]?\d{2}\s*(?:[aApP][mM])?)\s*$", 1))
    plain = s.put(F.translate(F.lower(F.nullif(plain, F.lit(""))), ":h \t\n\x0b\x0c\r", ""))
    number = s.put(F.rtrim(plain, F.lit("apm")))
    again = s.put(_day_hour(F.substr(number, F.lit(1), F.length(number) - 2).cast("int"), F.ltrim(plain, F.lit("0123456789"))))
    last = F.right(number, F.lit(2))
    return s.done(**{out: F.coalesce(repaired, F.when(again.between(0, 23) & (last.cast("int") <= 59), _clock(again, last)))})


def time_cleaned(df: DataFrame, col: str, out: str) -> DataFrame:
    """Time text without recognition noise, colons between hours and minutes where they can be told."""
    s = Steps(df, out)
    text = s.put(F.translate(strip(F.col(col)), "OoS", "005"))
    text = F.when(has(text, ".", "/", "\\"), F.regexp_replace(text, r"(?<=\d)[./\\](?=\d)", ":")).otherwise(text)
    text = s.put(F.regexp_replace(F.translate(text, ",", ":"), r"[^0-9apmAPM:]+", ""))
    text = s.put(F.btrim(F.when(has(text, "::"), F.regexp_replace(text, ":{2,}", ":")).otherwise(text), F.lit(":")))
    colons = s.put(count_of(text, ":"))
    text = s.put(F.when(colons > 1, F.concat(before(text, ":"), F.lit(":"), after(text, ":"))).otherwise(text))
    long = (colons > 0) & text.rlike(r"^\d{1,2}:\d{3,}$")
    tail = F.concat(F.lit(":"), F.right(text, F.lit(2)))
    bare = (colons == 0) & F.length(text).between(3, 5) & text.rlike(r"^\d+$")
    return s.done(**{out: F.when(long, F.concat(before(text, ":"), tail)).when(bare, F.concat(F.left(text, F.when(F.length(text) == 3, 1).otherwise(2)), tail)).otherwise(text)})


def time_parsed(df: DataFrame, col: str, out: str, warnings: str) -> DataFrame:
    """HH:MM and an array of warnings. Minutes are cut to 59, hours past 23 wrap; an afternoon mark adds 12 unchecked."""
    df = time_cleaned(df, col, f"__{out}_text")
    s = Steps(df, out)
    text, raw = F.col(f"__{out}_text"), F.col(col)
    text = s.put(F.when(text.rlike(r"^\d{1,2}(?::\d{1,2})?(?:am|pm|a|p|AM|PM|A|P)?$"), text))
    body = s.put(F.rtrim(text, F.lit(LETTERS)))
    hour = s.put(before(body, ":").cast("int"))
    half = s.put(F.lower(F.substr(text, F.length(body) + 1, F.lit(1))))
    minute = s.put(F.when(has(body, ":"), after(body, ":").cast("int")).otherwise(0))
    day = s.put(F.when(half == "", hour % 24).otherwise(F.when(hour == 12, 0).otherwise(hour) + F.when(half == "p", 12).otherwise(0)))
    notes = F.array_compact(F.array(F.when(minute > 59, "minutes>59"), F.when((half == "") & (hour > 23), "hour>23")))
    notes = F.when(raw.isNull(), F.array(F.lit("empty"))).when(hour.isNull(), F.array(F.concat(F.lit("unparsable('"), raw, F.lit("')")))).otherwise(notes)
    time = _clock(day, F.lpad(F.least(minute, F.lit(59)).cast("string"), 2, "0"))
    return s.done(**{out: time, warnings: notes}).drop(f"__{out}_text")


def minutes(time: Column) -> Column:
    """Minutes of HH:MM."""
    return (F.substring_index(time, ":", 1).cast("int") * 60 + F.substring_index(time, ":", -1).cast("int")).cast("int")


def from_minutes(n: Column) -> Column:
    """HH:MM of minutes; hours don't wrap, and are floored for negative ones."""
    hours = F.floor(n / 60)
    return F.concat(F.when((hours < 0) & (hours > -10), F.format_string("%d", hours)).otherwise(two_digits(hours)), F.lit(":"), two_digits(F.pmod(n, F.lit(60))))


SANITIZERS: dict[str, Callable[[DataFrame, str, str], DataFrame]] = {"amount": amount, "time": time_strict, "date": date}
#: Characters that a text of each kind may have.
ALLOWED = {"amount": r"^[()\-$\s\d.,]+$", "time": r"^[\s0-9:;.,\-apmAPM]+$", "date": r"^[\s0-9/.\-]+$"}


def allowed(text: Column, kind: str) -> Column:
    return text.rlike(ALLOWED[kind]) if kind in ALLOWED else F.lit(True)


def postprocess(df: DataFrame, col: str, kind: str, out: str, ok: str) -> DataFrame:
    """Sanitized text and whether that went well; else the squeezed text. Kind text is always well."""
    df = df.withColumn(f"__{out}_raw", squeezed(F.col(col)))
    if kind not in SANITIZERS:
        return df.withColumns({out: F.col(f"__{out}_raw"), ok: F.lit(True)}).drop(f"__{out}_raw")
    df = SANITIZERS[kind](df, f"__{out}_raw", f"__{out}_clean")
    clean = F.col(f"__{out}_clean")
    return df.withColumns({out: F.coalesce(clean, F.col(f"__{out}_raw")), ok: clean.isNotNull()}).drop(f"__{out}_raw", f"__{out}_clean")


def reviewed(df: DataFrame, col: str, kind: str, clean: str, sanitized: str, valid: str) -> DataFrame:
    """For review: text, whether it was sanitized, and whether it has the strict form. Kind text is valid if not blank."""
    if kind not in ("time", "amount"):
        text = strip(F.col(col))
        return df.withColumns({clean: text, sanitized: F.lit(False), valid: text != ""})
    df = SANITIZERS[kind](df, col, f"__{clean}")
    shape = r"^(?:[01]\d|2[0-3]):[0-5]\d$" if kind == "time" else r"^\$?\d{1,3}(?:,\d{3})*(?:\.\d{2})$"
    own = F.col(f"__{clean}")
    return df.withColumns({clean: F.coalesce(own, F.col(col)), sanitized: own.isNotNull(), valid: own.isNotNull() & own.rlike(shape)}).drop(f"__{clean}")


def typed_or_trimmed(df: DataFrame, col: str, kind: str, out: str) -> DataFrame:
    """The sanitized value, or else the stripped one; null counts as empty."""
    df = df.withColumn(f"__{out}_in", strip(F.coalesce(F.col(col), F.lit(""))))
    if kind not in SANITIZERS:
        return df.withColumn(out, F.col(f"__{out}_in")).drop(f"__{out}_in")
    return SANITIZERS[kind](df, f"__{out}_in", f"__{out}_san").withColumn(out, F.coalesce(f"__{out}_san", f"__{out}_in")).drop(f"__{out}_in", f"__{out}_san")


def html_escaped(c: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def image_number(path: Column) -> Column:
    """A stable 48-bit number of a path."""
    return F.conv(F.substring(F.md5(path), 1, 12), 16, 10).cast("long")


def hashed_name(path: Column) -> Column:
    """File name with a hash of the whole path before its extension."""
    base = F.substring_index(path, "/", -1)
    ext = F.regexp_extract(base, r".(\.[^.]*)$", 1)
    return F.concat(F.substring(base, F.lit(1), F.length(base) - F.length(ext)), F.lit("__"), F.substring(F.sha1(path), 1, 16), ext)


def field_class(name: Column) -> Column:
    return F.substring_index(name, "_r", 1)


def row_col(df: DataFrame, row: str, col: str, field_id: str, path: str) -> DataFrame:
    """Fills row and col, where null, from the field id and then from the path."""
    found = lambda c, what: F.regexp_extract(F.col(c), rf"(?i){what}[_\- ]?([0-9]+)", 1).try_cast("int")
    return df.withColumns({n: F.coalesce(F.col(n).cast("int"), found(field_id, w), found(path, w)) for n, w in ((row, "row"), (col, "col"))})


def crop_parts(path: Column) -> tuple[Column, Column]:
    """(image id, field name) of a crop's path: the third part from the end, and the base name without its extension."""
    parts = F.split(F.translate(path, "\\", "/"), "/")
    return F.try_element_at(parts, F.lit(-3)), F.regexp_replace(F.element_at(parts, -1), r"(?<=.)\.[^.]*$", "")


def field_type(key: Column) -> Column:
    """time or amount by the key's ending, else null."""
    low = F.lower(key)
    return F.when(low.rlike("clock_(in|out)_(am|pm)$"), "time").when(low.rlike("total_hours$"), "amount")


def bucket(name: Column) -> Column:
    has = lambda *words: F.lower(name).rlike("|".join(words))
    return (
        F.when(has("clock_in", "clock_out"), "time").when(has("lunch"), "lunch").when(has("total_hours"), "total_hours")
        .when(has("employee_name"), "name").when(has("signature"), "signature").otherwise("other")
    )


def is_time_field(name: Column) -> Column:
    """Whether a field's name says that it holds a time."""
    return F.contains(name, F.lit("clock_in")) | F.contains(name, F.lit("clock_out"))


def path_key(path: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(path, r"(?i)(row\d+_clock_(?:in|out)_(?:am|pm))", 1)), F.lit(""))


def split_warnings(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda w: strip(w)), lambda w: w != "")


def merged(*arrays: Column) -> Column:
    """Warnings of several lists, each once, in the order first met."""
    return F.array_distinct(F.concat(*(F.coalesce(a, F.array().cast("array<string>")) for a in arrays)))
