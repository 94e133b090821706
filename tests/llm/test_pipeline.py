import random

from pyspark.sql import functions as F

import corpus_pipeline
from formloom.llm import simhash


def sets(text, k=5):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_distinct_against_brute_force(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(60):
        base = [rng.choice(vocab) for _ in range(rng.choice([8, 30, 120, 400]))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.choice([0, 0, 1, 3, 8])):
            copy = list(base)
            for i in rng.sample(range(len(copy)), max(1, len(copy) // 60)):
                copy[i] = rng.choice(vocab)
            rows.append((len(rows), " ".join(copy) + rng.choice(["", " end"])))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " "), (3, rows[3][1]), (None, rows[5][1]), (None, "only here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash")).withColumn("n", F.lit(1))
    s = [sets(t) for _, t in rows]
    comp = list(range(len(rows)))
    for _ in range(6):
        for i in range(len(rows)):
            comp[i] = min(comp[j] for j in range(len(rows)) if jaccard(s[i], s[j]) >= 0.8 or i == j)
    want = {}
    for i, (d, _) in enumerate(rows):
        want.setdefault(comp[i], []).append((d is None, d))
    out = simhash.distinct(df)
    assert out.columns == df.columns
    got = sorted((r.doc_id is None, r.doc_id) for r in out.collect())
    assert got == sorted(min(v) for v in want.values())
    assert simhash.distinct(df.limit(0)).count() == 0


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, given = docs.columns, {r.doc_id: r for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame((rows := stage(spark, docs, sf).collect()), docs.schema)
        assert docs.columns == columns
        kept.append(rows)
    accepted, distinct, private, mixed = kept
    assert 0 < len(distinct) < len(accepted) < len(given) and all(given[r.doc_id] == r for r in distinct)
    assert [r.doc_id for r in sorted(private)] == [r.doc_id for r in sorted(distinct)] and all(r.n_chars == len(r.text) for r in private)
    assert not any("@mail" in r.text for r in private if "@mail" in given[r.doc_id].text and r.text == given[r.doc_id].text)
    words = lambda rows: sum(len(r.text.split()) for r in rows)
    assert abs(words(mixed) - 1.5 * words(private)) < 0.02 * words(private)
    out = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in mixed}


def test_stages_take_odd_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = docs.limit(20).unionByName(docs.limit(5)).unionByName(spark.createDataFrame([(None,) * 5, (1 << 40, "", None, None, None), (None, "some text", "en", "s", 1)], docs.schema))
    odd = odd.withColumn("keep", F.lit("clash")).withColumn("size", F.lit(1)).withColumns({c: F.lit(2) for c in ("n", "k", "col", "copies", "n_entities", "node", "shard", "fp")})
    for table in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            columns = table.columns
            table = spark.createDataFrame((out := stage(spark, table, sf)).collect(), out.schema)
            if name != "packing":
                assert table.columns == columns and {(r.keep, r.size, r.n_entities, r.copies) for r in table.collect()} <= {("clash", 1, 2, 2)}
        assert "sequence_id" in table.columns
