"""Mixing sources to target weights by entropy balancing.

Targets: sources in code-point order, null last, get the weights in turn and share `share` times all words; a target
stops at `most` times its source's words, and what is above goes to the others by weight. With s words and weight w,
targets are min(most * s, level * w): the level follows from running sums over the sources ordered by most * s / w.

Rates: of all document rates r in [0, most] whose words sum to their source's target, those nearest to 1 in
relative entropy are r = min(most, exp(lambda * size / mean)), one lambda a source. The lambdas maximise a concave
dual; Newton steps, kept within a bracket, solve all sources at once. A step is one aggregation over the table of
(source, size, documents), to which a rate's arguments reduce the documents.

Copies: sizes are visited from large to small within a source; each (source, size) group gets the whole copies that
bring the words so far nearest to the rates' words so far, so that a source misses its target by about its smallest
document. The copies of a group are dealt to its documents as evenly as may be, the odd ones by hash order; ranks
within a group are counted over BUCKETS hash ranges, so a group of any size is spread; rows with equal ids and texts share a range.

Null or empty texts have size 0; they keep one copy and take no words. Repeated rows are rows of their own. An input
column with the name of a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Scratch

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2
BUCKETS = 1024
#: Newton ends when all sources' words are within this share of their targets.
CLOSE, STEPS = 1e-7, 60


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds target to sources (source, words). One row a source goes through one task."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.withColumn("w", w).withColumn("cap", F.lit(float(most)) * F.col("words")).withColumn("ratio", F.col("cap") / F.col("w"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.lit(share) * F.sum("words").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    ranked = ranked.withColumn("level", level)
    ranked = ranked.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(whole)["level"])
    target = F.coalesce(F.least("cap", F.col("level") * F.col("w")), F.col("cap"))
    return ranked.select(*sources.columns, target.alias("target"))


def rate(lam, size, mean, most: int = MOST):
    return F.least(F.lit(float(most)), F.exp(F.least(lam * size / mean, F.lit(700.0))))


def solve(sizes: DataFrame, goals: DataFrame, scratch: Scratch, most: int = MOST) -> DataFrame:
    """Adds lam to goals (key, words, n, target) by Newton steps over sizes (key, size, n)."""
    mean = F.greatest(F.col("words"), F.lit(1)) / F.greatest(F.col("n"), F.lit(1))
    # At hi all rates are `most`, for a size is 1 at least; at lo the words are below the target.
    hi = F.log(F.lit(float(most))) * F.col("mean")
    lo = F.least(F.lit(0.0), -F.col("mean") * F.log(F.greatest("words", F.lit(1)) / F.greatest("target", F.lit(1e-9))))
    state = goals.withColumn("mean", mean).withColumn("hi", hi).withColumn("lo", lo)
    full = F.col("target") >= most * F.col("words") * (1 - 1e-12)
    state = scratch.save(state.withColumn("lam", F.when(full, F.col("hi")).otherwise(F.lit(0.0))), "state0")
    for step in range(1, STEPS):
        r = rate(F.col("lam"), F.col("size"), F.col("mean"), most)
        tokens = F.col("s.n") * F.col("size") * r
        slope = F.when(r < most, tokens * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            sizes.alias("s").join(state.alias("t"), "key")
            .groupBy("key").agg((F.sum(tokens) - F.first("target")).alias("gap"), F.sum(slope).alias("slope"))
        )
        now = state.join(sums, "key", "left").fillna(0.0, ["gap", "slope"])
        now = now.withColumn("lo", F.when(F.col("gap") < 0, F.col("lam")).otherwise(F.col("lo")))
        now = now.withColumn("hi", F.when(F.col("gap") > 0, F.col("lam")).otherwise(F.col("hi")))
        newton = F.when(F.col("slope") > 0, F.col("lam") - F.col("gap") / F.col("slope"))
        inside = (newton > F.col("lo")) & (newton < F.col("hi"))
        done = F.abs("gap") <= CLOSE * F.greatest("target", F.lit(1.0))
        move = F.when(done, F.col("lam")).when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2)
        now = scratch.save(now.withColumn("done", done).withColumn("lam", move), f"state{step}")
        open_ = now.where("not done").limit(1).count()
        state = now.select(*state.columns)
        scratch.drop(f"state{step - 1}")
        if not open_:
            break
    else:
        raise RuntimeError(f"{STEPS} Newton steps did not bring all sources within {CLOSE} of their targets")
    return state.select(*goals.columns, "mean", "lam")


def copies(sizes: DataFrame, goals: DataFrame, most: int = MOST) -> DataFrame:
    """(key, size, n, copies) for each size of each source. A task gets the distinct sizes of one source."""

    def run(pdf):
        import math

        pdf = pdf.sort_values("size", ascending=False)
        made, carry = [], 0.0
        for size, n, r in zip(pdf["size"], pdf["n"], pdf["rate"]):
            want = carry + n * r * size
            k = n if size == 0 else min(most * n, max(0, math.floor(want / size + 0.5)))
            carry = want - k * size
            made.append(k)
        return pdf[["key", "size", "n"]].assign(copies=made)

    rated = sizes.join(goals.select("key", "lam", "mean"), "key").withColumn("rate", rate(F.col("lam"), F.col("size"), F.col("mean"), most))
    return rated.groupBy("key").applyInPandas(run, "key string, size long, n long, copies long")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The rows of `df` with size, source_size, target, rate and copies."""
    scratch = Scratch(df.sparkSession, "mixture")
    results = ["size", "source_size", "target", "rate", "copies"]
    source = F.col(source_col).cast("string")
    rows = df.select(
        *(c for c in df.columns if c not in results),
        word_count(F.col(text_col)).alias("size"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("_key"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("_hash"),
    )
    rows = rows.withColumn("_bucket", F.shiftrightunsigned("_hash", 54).cast("int"))
    counts = scratch.save(rows.groupBy(F.col("_key").alias("key"), "size", F.col("_bucket").alias("bucket")).agg(F.count("*").alias("m")), "counts")
    sizes = scratch.save(counts.groupBy("key", "size").agg(F.sum("m").alias("n")), "sizes")
    goals = sizes.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("n"))
    goals = targets(goals.withColumn("source", F.when(F.col("key") != "", F.substring("key", 2, 1 << 30))), weights, share, most).drop("source")
    goals = scratch.save(solve(sizes, scratch.save(goals, "goals"), scratch, most), "solved")
    dealt = copies(sizes, goals, most)
    offsets = F.coalesce(F.sum("m").over(Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    plan = (
        counts.join(dealt, ["key", "size"]).withColumn("before", offsets)
        .join(goals.select("key", F.col("words").alias("source_size"), "target", "lam", "mean"), "key")
        .withColumn("rate", rate(F.col("lam"), F.col("size"), F.col("mean"), most))
        .select(F.col("key").alias("_key"), F.col("size"), F.col("bucket").alias("_bucket"), F.col("n").alias("_n"), F.col("copies").alias("_k"), F.col("before").alias("_before"), "source_size", "target", "rate")
    )
    plan = scratch.save(plan, "plan")
    keys = ["_key", "size", "_bucket"]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_hash", id_col)) - 1 + F.col("_before")
    out = rows.join(plan, keys).withColumn("copies", F.floor(F.col("_k") / F.col("_n")) + (rank < F.col("_k") % F.col("_n")).cast("long"))
    return out.select(*(c for c in df.columns if c not in results), *results)
