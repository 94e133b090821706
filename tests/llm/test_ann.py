import numpy as np
from pyspark.sql import functions as F

from formloom.llm import ann, queries


def vectors(rows):
    return {i: np.array(v, np.float32).astype(np.float64) for i, v in rows if v is not None and i is not None}


def brute(rows, k=20):
    x = vectors(rows)
    ids = np.array(sorted(x))
    m = np.stack([x[i] for i in ids])
    out = {}
    for q in ids[ids % 20 == 0]:
        s = (m * x[q]).sum(1)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(found, want):
    return np.mean([len({i for i, _ in found.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items()])


def test_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    found, want, x = got(queries.op6_ann(spark, "/root/testdata/sf0.1")), brute(rows), vectors(rows)
    assert set(found) == set(want) and all(len(v) == 20 for v in found.values()) and recall(found, want) >= 0.92
    for q, near in found.items():
        assert near == sorted(near, key=lambda n: (-n[1], n[0])) and q not in [i for i, _ in near]
        assert all(abs(s - (x[q] * x[i]).sum()) < 1e-12 for i, s in near)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS", 40)
    monkeypatch.setattr(ann, "QUERIES", 3)
    rng = np.random.RandomState(1)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(200)] + [(1000 + i, [1.0] * 8) for i in range(300)]
    bad = [(2000, None), (2020, [0.0] * 8), (2040, [1.0] * 7 + [None]), (2060, [float("nan")] * 8), (2080, [float("inf")] + [1.0] * 7), (2100, [1.0] * 3), (None, [9.0] * 8)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("list", F.lit("clash"))
    out = got(ann.search(df, "vec_id", "embedding", lambda i: i % 20 == 0))
    want = brute(rows)
    assert set(out) == set(want) and recall(out, want) >= 0.9
    assert [i for i, _ in out[1000]] == [i for i, _ in want[1000]]  # ties
    few = got(ann.search(df.where("vec_id in (0, 1, 2)"), "vec_id", "embedding", lambda i: i % 20 == 0))
    assert [i for i, _ in few[0]] == [i for i, _ in brute([r for r in rows if r[0] < 3])[0]]
    assert ann.search(df.limit(0), "vec_id", "embedding", lambda i: i % 20 == 0).count() == 0
    assert ann.search(df.where("vec_id = 0"), "vec_id", "embedding", lambda i: i % 20 == 0).count() == 0
    twice = got(ann.search(df.where("vec_id < 200").unionByName(df.where("vec_id < 200")), "vec_id", "embedding", lambda i: i % 20 == 0))
    assert all(len(v) == 20 for v in twice.values())


def test_exact_and_doubles(spark, monkeypatch):
    """All lists and nothing abandoned gives the neighbours themselves; doubles stay doubles, beyond the range of floats too."""
    for name, value in (("ROWS", 50), ("QUERIES", 4)):
        monkeypatch.setattr(ann, name, value)
    rng = np.random.RandomState(2)
    for scale in (1.0, 1e60):
        rows = [(i, (rng.standard_normal(12) * scale).tolist()) for i in range(700)] + [(900 + i, (np.full(12, 0.3) * scale).tolist()) for i in range(60)]
        out = got(ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", lambda i: i % 20 == 0, exact=True))
        x = {i: np.array(v) for i, v in rows}
        ids = np.array(sorted(x))
        m = np.stack([x[i] for i in ids])
        for q in ids[ids % 20 == 0]:
            s = (m * x[q]).sum(1)
            want = [int(ids[j]) for j in np.lexsort((ids, -s)) if ids[j] != q][:20]
            assert [i for i, _ in out[int(q)]] == want and all(v == (x[q] * x[i]).sum() for i, v in out[int(q)])


def test_small_lists_are_topped_up(spark):
    """Tight clusters of fewer than k vectors: each query still gets k of them."""
    rng = np.random.RandomState(3)
    centers = rng.standard_normal((60, 16)) * 10
    rows = [(i, (centers[i % 60] + rng.standard_normal(16) * 1e-3).tolist()) for i in range(600)]
    out = got(ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding", lambda i: i % 20 == 0, recall=0.3))
    assert len(out) == 30 and all(len(v) == 20 for v in out.values())
