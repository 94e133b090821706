import random

import xxhash
from pyspark.sql import functions as F

from formloom.llm import simhash


def brute_fp(text, width):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w)] if len(w) < width else [b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, width, radius):
    fps = [brute_fp(t, width) for _, t in rows]
    comp = list(range(len(rows)))
    find = lambda x: x if comp[x] == x else find(comp[x])
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((d, f"{fps[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_matches_brute_force_on_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(simhash.near_duplicates(docs, width=4, radius=4)) == brute(rows, 4, 4)


def test_odd_rows(spark):
    rows = [(3, None), (1, ""), (2, " \t\n"), (None, "a b c d e"), (7, "A b C d e"), (7, "A b C d e"), (9, "one"), (8, "x " * 5000),
            (5, "é b c d e f"), (6, "É b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("shard", F.lit(1))
    assert got(simhash.near_duplicates(docs, width=4, radius=4)) == brute(rows, 4, 4)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_hot_shards_meet_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TREE", 16)
    rng = random.Random(4)
    base = rng.getrandbits(63)
    fps = list({base ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) ^ (rng.getrandbits(60) if i % 3 == 0 else 0) for i in range(300)})
    df = spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "id long, fp long")
    out = {r.id: r.component_id for r in simhash.linked(spark, df, 4).collect()}
    comp = list(range(len(fps)))
    for _ in range(12):
        for i in range(len(fps)):
            comp[i] = min(comp[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 4)
    assert out == dict(enumerate(comp))


def test_tree_finds_all_within_radius():
    rng = random.Random(1)
    values = [rng.getrandbits(16) for _ in range(500)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:50]:
        assert sorted(p for _, p in tree.near(q, 3)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= 3]
