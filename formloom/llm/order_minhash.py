"""Order MinHash: fingerprints whose likeness follows edit distance, from DataFrame functions alone.

A text's k-mers are its runs of K code points (a shorter text is one k-mer; an empty or null text has none), each
with its occurrence number. Each (k-mer, occurrence) is hashed by itself, however often the k-mer occurs: the hash gives
its sketch, one of SKETCHES, and its order value. Each sketch keeps the TUPLE smallest of all. A sketch with fewer than TUPLE (short
texts have such) borrows the first ones that the next sketches kept, around the circle of sketches (densification by rotation), so that no sketch is
empty. The kept ones of a sketch are put into text order and hashed as a tuple. Likeness is the share of equal tuples, and 1 for two texts without k-mers, whose
sketches are zeros.

Work: one pass hashes all k-mers, and a sort brings equal ones together and those of small order value to the front. Of these the first
occurrences are taken up to a limit, set such that a sketch expects KEPT. A second pass finds repeated ones, whose hash is yet to
come. If a sketch is then left with fewer than TUPLE, the text is done without a limit, so the result is always that of all k-mers and occurrences.

A key has 28 bits of order value, 6 of sketch and 29 of position (in bytes of UTF-32): results are exact for texts of up to 67 million code
points. K-mers of equal sketch and order value (34 bits) count as equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key has 6 bits for its sketch; tuples are pairs.
K, SKETCHES, TUPLE, KEPT = 12, 64, 2, 10
PLACE, MOST = (1 << 29) - 1, (1 << 63) - 1
#: Documents of a range of ids, and the most ranges.
RANGE, RANGES = 500, 1 << 16


def _let(name: str, value: str, body: str) -> str:
    """SQL of `body`, in which `name` stands for `value`, worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _key(h: str, place: str) -> str:
    """SQL: a hash's bits above the position, without the sign, and a position."""
    return f"({h} & {MOST - PLACE}L) | ({place})"


def _alike(key: str, last: str) -> str:
    """SQL: whether the key before in order is of the same k-mer; null if there is none. Keys of one k-mer differ by positions only."""
    return f"{key} - {last} <= span"


def _chosen(limit: str) -> str:
    """SQL: keys of all (k-mer, occurrence) up to the limit, of the sorted keys s of first hashes; with the sketch in front, then the order value."""
    steps = "filter(transform(sequence(29, 0), b -> cast(shiftleft(1, b) as int)), b -> b <= size(s))"
    below = f"aggregate(steps, 0, (at, step) -> if(get(s, at + step - 1) <= {limit}, at + step, at))"
    first = _let("t", f"slice(s, 1, {below})", f"filter(t, (x, j) -> j = 0 or not ({_alike('x', 't[j - 1]')}))")
    # Repeated k-mers by runs of equal ones, numbered from 2 on.
    again = _key("xxhash64(shiftright(x, 29), k + 2)", f"x & {PLACE}L")
    run = f"transform(slice(r, at + 1, coalesce(get(b, i + 1), size(r)) - at), (x, k) -> {again})"
    runs = _let("b", f"filter(sequence(0, size(r) - 1), j -> j = 0 or not ({_alike('r[j]', 'r[j - 1]')}))", f"flatten(transform(b, (at, i) -> {run}))")
    again = _let("r", f"filter(s, (x, j) -> {_alike('x', 'get(s, j - 1)')})", f"if(size(r) = 0, r, filter({runs}, x -> x <= {limit}))")
    turned = f"shiftleft(shiftright(x, 29) & 63L, 57) | shiftleft(shiftright(x, 35), 29) | (x & {PLACE}L)"
    return _let("steps", steps, f"transform(concat({first}, {again}), x -> {turned})")


def _pair(x: str, y: str) -> str:
    place = f"& {PLACE}L"
    a, b = f"shiftright({x}, 29)", f"shiftright({y}, 29)"
    return f"(shiftrightunsigned(if(({x} {place}) < ({y} {place}), xxhash64({a}, {b}), xxhash64({b}, {a})), 32) | 1)"


def signature(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Adds `out`, the tuple hashes of a non-null text, as array<bigint>; 0 for a sketch of a text without k-mers.
    Sorts are columns of their own: there they are compiled and sort plain numbers."""
    df = df.withColumn("_n", F.length(text_col)).withColumn("_points", F.encode(F.col(text_col), "UTF-32"))
    df = df.withColumn("_cut", F.expr(f"if(_n <= {SKETCHES * KEPT}, {MOST}L, shiftleft(cast({1 << 28}D * {SKETCHES * KEPT} / _n as bigint), 35))"))
    # A column's bytes are copied each time that a lambda reads them; a lambda's own variable is not.
    hashed = _key(f"xxhash64(substring(c, at, {4 * K}))", "at")
    hashed = _let("c", "_points", f"transform(sequence(1, 4 * greatest(_n - {K}, 0) + 1, 4), at -> {hashed})")
    df = df.withColumn("_keys", F.expr(f"sort_array(if(_n = 0, cast(array() as array<bigint>), {hashed}))"))
    of = lambda limit: _let("span", "4L * _n", _let("s", "_keys", limit))
    df = df.withColumn("_few", F.expr(f"sort_array({of(_let('most', '_cut', _chosen('most')))})"))
    first = lambda t: _let("t", t, f"filter(t, (x, j) -> j < {TUPLE} or shiftright(t[j - {TUPLE}], 57) <> shiftright(x, 57))")
    df = df.withColumn("_first", F.expr(f"if(size(_few) > 0, {first('_few')}, _few)"))
    full = SKETCHES * TUPLE
    enough = f"size(_first) = {full} or _cut = {MOST}L"
    df = df.withColumn("_all", F.expr(f"if({enough}, _few, sort_array({of(_chosen(f'{MOST}L'))}))")).withColumn("_first", F.expr(f"if({enough}, _first, {first('_all')})"))
    # How many kept ones are of sketches before: a sketch's own begin there, or those of the next ones that have some.
    at = f"aggregate(steps, 0, (at, step) -> if(shiftright(get(a, at + step - 1), 57) < b, at + step, at))"
    single = "shiftrightunsigned(xxhash64(shiftright(a[0], 29)), 32) | 1"
    tuple_ = _let("i", at, f"if(size(a) = 1, {single}, {_pair('a[i % size(a)]', 'a[(i + 1) % size(a)]')})")
    sketches = f"sequence(0, {SKETCHES - 1})"
    found = _let("steps", f"array({', '.join(str(1 << i) for i in range(7, -1, -1))})", f"transform({sketches}, b -> {tuple_})")
    made = f"case size(a) when 0 then transform({sketches}, b -> 0L) when {full} then transform({sketches}, b -> {_pair('a[2 * b]', 'a[2 * b + 1]')}) else {found} end"
    return df.withColumn(out, F.expr(_let("a", "_first", made))).drop("_points", "_n", "_cut", "_keys", "_few", "_first", "_all")


def text_form(signature_col: str) -> Column:
    return F.lower(F.array_join(F.transform(F.col(signature_col), lambda v: F.lpad(F.hex(v), 8, "0")), ""))


def likeness(a: str, b: str) -> Column:
    return F.expr(f"size(filter(zip_with({a}, {b}, (x, y) -> x = y), x -> x)) / cast({SKETCHES} as double)")


def fingerprints(df: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """The rows of `df` with their fingerprint (8 hex digits a sketch). A null text counts as an empty one."""
    named = df.select(*(c for c in df.columns if c != out), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    return signature(named, "_text", "_sig").withColumn(out, text_form("_sig")).drop("_text", "_sig")


def with_next(df: DataFrame, key: str, order: list[str], carried: list[str]) -> DataFrame:
    """Adds next_<c> for the carried columns: their values in the next row by key (nulls last), ties by `order`; after
    the last row comes the first. Rows are dealt by ranges of keys; each range also gets the first row of the next one,
    so one shuffle does and no task holds more than a range. A key that repeats stays in one range."""
    few = max(1, min(RANGES, df.count() // RANGE))
    cuts = df.agg(F.percentile_approx(key, [i / few for i in range(few)], max(10_000, 4 * few))).first()[0]
    least = df.agg(F.min(key)).first()[0]
    cuts = sorted({least, *cuts}) if cuts else [0]
    levels = max(1, (len(cuts) - 1).bit_length())
    padded = F.array(*map(F.lit, cuts)) if len(cuts) < 64 else F.from_json(F.lit(str(cuts)), "array<bigint>")
    step = lambda lo, s: F.when((lo + s < len(cuts)) & (F.get(F.col("_cuts"), lo + s) <= F.col(key)), lo + s).otherwise(lo)
    own = F.aggregate(F.array(*(F.lit(1 << (levels - 1 - i)) for i in range(levels))), F.lit(0), step)
    last = len(cuts) - 1
    dealt = df.withColumn("_cuts", padded).withColumn("_own", F.when(F.col(key).isNull(), F.lit(last)).otherwise(own))
    opens = F.col(key) == F.get(F.col("_cuts"), F.col("_own"))
    before = F.struct(F.when(F.col("_own") > 0, F.col("_own") - 1).otherwise(last).alias("range"),
                      F.when(F.col("_own") > 0, 1).otherwise(2).alias("lent"))
    here = F.struct(F.col("_own").alias("range"), F.lit(0).alias("lent"))
    dealt = dealt.withColumn("_at", F.explode(F.when(opens, F.array(here, before)).otherwise(F.array(here))))
    dealt = dealt.select(*df.columns, F.col("_at.range").alias("_range"), F.col("_at.lent").alias("_lent"))
    by = Window.partitionBy("_range").orderBy("_lent", F.col(key).asc_nulls_last(), *order)
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pack = F.struct(*carried)
    found = dealt.withColumn("_next", F.coalesce(F.lead(pack).over(by), F.first(pack).over(whole))).where("_lent = 0")
    return found.select(*df.columns, *(F.col(f"_next.{c}").alias(f"next_{c}") for c in carried))


def edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_text, signatures): each text, its edited text, and the next document's signature. Edited: the last
    half, rounded down, of the code points makes way for as many first ones of the next text, or for all that it has."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    pairs = with_next(signature(rows, "t", "sig"), "id", ["t"], ["t", "sig"])
    n = F.length("t")
    pairs = pairs.withColumn("n_chars", n.cast("long")).withColumn("half", F.floor(n / 2).cast("int"))
    pairs = pairs.withColumn("edited_text", F.concat(F.left("t", F.length("t") - F.col("half")), F.left("next_t", F.col("half"))))
    return signature(pairs.drop("t", "next_t", "half"), "edited_text", "edited_sig")


def compared(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return edited(df, id_col, text_col).select(
        F.col("id").alias(id_col),
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        text_form("sig").alias("fingerprint"),
        text_form("edited_sig").alias("edited_fingerprint"),
        likeness("sig", "edited_sig").alias("near_edited"),
        likeness("sig", "next_sig").alias("near_next"),
    )
