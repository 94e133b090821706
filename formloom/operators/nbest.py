"""Re-ranking of candidate readings, softmax choice, and triage for review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def exploded(df: DataFrame, candidates: str, logprobs: str) -> DataFrame:
    """A row a candidate: pos, cand, logp. Lists of different lengths are refused."""
    same = F.assert_true(F.size(candidates) == F.size(logprobs), F.lit("candidates and log-probabilities differ in number"))
    pairs = F.arrays_zip(F.col(candidates).alias("cand"), F.col(logprobs).alias("logp"))
    out = df.where(same.isNull()).select(*(c for c in df.columns if c not in (candidates, logprobs)), F.posexplode(pairs).alias("pos", "pair"))
    return out.select(*(c for c in out.columns if c != "pair"), F.col("pair.cand").alias("cand"), F.col("pair.logp").alias("logp"))


def scored(df: DataFrame, kind: str, length_bias: float = 0.0) -> DataFrame:
    """Adds clean, score and note to rows of cand and logp."""
    df = text.postprocess(df.withColumn("norm", text.squeezed(F.col("cand"))), "norm", kind, "clean", "_ok")
    typed = kind in text.SANITIZERS
    if typed:
        df = text.SANITIZERS[kind](df, "clean", "_again")
    good, allowed = F.col("_again").isNotNull() if typed else F.lit(False), text.allowed(F.col("norm"), kind)
    far = F.levenshtein("norm", "clean")
    finite = F.col("logp").isNotNull() & ~F.isnan("logp") & (F.abs("logp") < float("inf"))
    score = (
        F.when(finite, F.col("logp").cast("double")).otherwise(F.lit(-1e9))
        - F.when(allowed, 0.0).otherwise(3.0 if kind == "amount" else 2.0)
        + F.when(F.col("_ok"), 2.0).otherwise(0.0)
        + F.when(good, 1.5).otherwise(0.0)
        - F.lit(0.05) * far
        - F.lit(float(length_bias)) * F.length("norm")
    )
    bits = F.array(
        F.when(~allowed, "prefilter_fail"), F.when(F.col("_ok"), "sanitized_ok"), F.when(good, f"{kind}_valid"),
        F.when(far > 0, F.concat(F.lit("lev-"), far.cast("string"))), F.lit(f"len_bias({length_bias})" if length_bias else None).cast("string"),
    )
    note = F.array_join(F.array_compact(bits), ",")
    return df.withColumn("score", score).withColumn("note", F.when(note == "", "ok").otherwise(note)).drop("_ok", "_again")


def ranked(df: DataFrame, keys: list[str], kind: str, length_bias: float = 0.0) -> DataFrame:
    """Adds rank within `keys`: score, then shorter, then first given."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.length("norm"), "pos")
    return scored(df, kind, length_bias).withColumn("rank", F.row_number().over(order))


def local_choice(df: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """The simpler ranking: 1 for a sanitized value, less for doubled marks and letters; the first best wins."""
    df = df.withColumn("raw", text.strip(F.coalesce("cand", F.lit("")))).withColumn("compact", F.replace("raw", F.lit(" "), F.lit("")))
    typed = kind in ("time", "amount")
    df = text.SANITIZERS[kind](df, "compact", "san") if typed else df.withColumn("san", F.col("compact"))
    bonus = (F.when(F.col("san").isNotNull(), 1.0).otherwise(0.0) if typed else F.lit(0.0)) - F.when(F.col("compact").rlike(r"\.\.|,,"), 0.5).otherwise(0.0)
    if typed:
        bonus = bonus - F.when(F.col("compact").rlike("[A-Za-z]"), 0.5).otherwise(0.0)
    df = df.withColumn("total", F.col("logp") + bonus).withColumn("sanitized", F.coalesce(F.nullif("san", F.lit("")), F.col("compact")))
    best = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("total"), "pos"))
    return df.withColumn("_n", best).where("_n = 1").select(*keys, "raw", "sanitized", "total")


def softmax(logits: Column) -> Column:
    """Probabilities of an array of logits."""
    raised = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def confidence(logits: Column) -> Column:
    """The largest probability; 1 for a single reading and 0 for none."""
    total = F.aggregate(F.transform(logits, lambda x: F.exp(x - F.array_max(logits))), F.lit(0.0), lambda a, b: a + b)
    return F.when(F.size(logits) == 0, 0.0).otherwise(1 / total)


def sequence_logprob(step_logprobs: Column, tokens: Column, eos: int) -> Column:
    """Sum of the chosen tokens' log-probabilities up to the first end mark."""
    at = F.array_position(tokens, eos).cast("int")
    return F.aggregate(F.slice(step_logprobs, 1, F.when(at > 0, at).otherwise(F.size(step_logprobs))), F.lit(0.0), lambda a, b: a + b)


def triaged(df: DataFrame, pred: str, model_conf: str, kind: str, threshold: float = 0.6) -> DataFrame:
    """Adds clean, sanitized, valid, final_conf and needs_review (flags as 0 and 1)."""
    df = text.reviewed(df, pred, kind, "clean", "_san", "_valid")
    raised = F.col(model_conf) + F.when(F.col("_san"), 0.15).otherwise(0.0) + F.when(F.col("_valid"), 0.15).otherwise(0.0)
    df = df.withColumn("final_conf", F.least(F.greatest(raised, F.lit(0.0)), F.lit(0.99)))
    review = (F.col("final_conf") < threshold) | ~F.col("_valid")
    return df.withColumns(
        {"sanitized": F.col("_san").cast("int"), "valid": F.col("_valid").cast("int"), "needs_review": review.cast("int"), "final_conf": F.round("final_conf", 4)}
    ).drop("_san", "_valid")
