import math
import random
from collections import Counter

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from formloom.llm import lm, queries


def brute(rows, order=2):
    """Scores from counts of the words themselves, each document's own counts taken away."""
    grams = lambda w: Counter(tuple(w[i : i + m]) for m in range(1, order + 1) for i in range(len(w) - m + 1))
    docs = [(d, [None, *w] if (w := (t or "").encode().lower().split()) else []) for d, t in rows]
    counts = sum((grams(w) for _, w in docs), Counter())
    total, out = sum(max(len(w) - 1, 0) for _, w in docs), []
    for d, w in docs:
        own, s, n = grams(w), 0.0, max(len(w) - 1, 0)
        c = lambda gram: counts[gram] - own[gram]  # noqa: E731, B023
        for i in range(1, len(w)):
            lost = 0
            for m in range(min(order, i + 1), 0, -1):
                gram = tuple(w[i - m + 1 : i + 1])
                if m == 1 or c(gram):
                    chance = c(gram) / c(gram[:-1]) if m > 1 else (c(gram) or lm.BACKOFF) / max(total - n, 1)
                    s += math.log10(chance) + lost * math.log10(lm.BACKOFF)
                    break
                lost += 1
        out.append((d, n, s, s / n if n else None))
    return out


def same(got, want, places=9):
    order = lambda r: (str(r[0]), r[1], round(r[2], 4))
    got, want = sorted((tuple(r) for r in got), key=order), sorted(want, key=order)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(g[2] == pytest.approx(w[2], rel=10**-places, abs=10**-places) and (g[3] is None) == (w[3] is None) for g, w in zip(got, want))


def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    same(queries.op8_lm(spark, sf).collect(), brute(rows), 4)


def test_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.sql(queries.ORACLE_SQL["op8_lm"])
    got = queries.op8_lm(spark, sf)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_odd_rows(spark, monkeypatch):
    for name, value in (("BLOCK_DOCS", 3), ("BLOCK_WORDS", 50)):
        monkeypatch.setattr(lm, name, value)
    rows = [(1, None), (2, ""), (3, "a b a b A B"), (3, "a b a b A B"), (None, "a c"), (5, "x " * 3000), (6, "Ünï b\x0bc"), (7, " \n\t"), (8, "only here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).repartition(3)
    same(lm.score(df).collect(), brute(rows))
    assert lm.score(df.limit(0)).count() == 0
    same(lm.score(df.where("doc_id = 1")).collect(), [(1, 0, 0.0, None)])
    same(lm.score(df.where("doc_id = 8")).collect(), brute(rows[-1:]))


def sharing_a_class(n):
    """Pairs of words that a hash into 2^22 classes does not tell apart."""
    seen, found, i = {}, [], 0
    while len(found) < n:
        word = f"word{i}"
        own = xxhash.xxh64_intdigest(word.encode(), 42) % ((1 << 22) - 1)
        if own in seen:
            found.append((seen[own], word))
        seen[own], i = word, i + 1
    return found


def test_words_that_share_a_class_keep_their_counts(spark):
    rows = [(i, f"{a} " * 40 + f"x{i} {b} y{i}") for i, (a, b) in enumerate(sharing_a_class(4))] + [(9, "x1 x2 y3")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(lm.score(df).collect(), brute(rows))


@pytest.mark.parametrize("order", [1, 3, 4])
def test_orders(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "BLOCK_DOCS", 3)
    rng = random.Random(order)
    rows = [(i, " ".join(rng.choices("a b c d e f".split(), k=rng.choice([0, 1, 2, 3, 40])))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(lm.score(df, order=order).collect(), brute(rows, order))
