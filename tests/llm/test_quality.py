import numpy as np
import pytest
from pyspark.sql import functions as F

from formloom.llm import quality as q
from formloom.llm import queries


def test_held_out_accuracy(spark):
    """Labels of every third labelled document are withheld; they are the yardstick."""
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    third = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) == 0
    out = q.classify(spark.read.parquet(f"{d}/documents.parquet"), labels.where(~third))
    rows = out.join(labels.where(third), "doc_id").select("quality", "toxic", "keep").collect()
    bad = [r.keep for r in rows if r.quality == 0]
    toxic = [r.keep for r in rows if r.toxic == 1]
    clean = [r.keep for r in rows if r.quality == 1 and r.toxic == 0]
    assert np.mean(bad) < 0.05 and np.mean(toxic) < 0.15 and np.mean(clean) > 0.99


def test_every_document_once_and_the_same_again(spark, sf):
    once, again = (sorted(queries.op4_quality(spark, sf).collect()) for _ in range(2))
    assert once == again and [r.doc_id for r in once] == sorted(r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect())


def test_odd_rows(spark):
    good = "the quick brown fox jumps over a lazy dog while birds sing in the old trees near water"
    rows = [(i, good + f" {i} words more") for i in range(60)] + [(100 + i, "BUY!! NOW!! CHEAP!! " * 20) for i in range(10)]
    rows += [(200, None), (201, ""), (202, " \n"), (None, good), (1, good), (203, "x " * 40000), (204, "a" * 100000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (None, 0, 1), (100, 0, 0), (5, 1, None)], "doc_id long, quality int, toxic int")
    for own in (labels, None, labels.limit(0)):
        out = {(r.doc_id, i): r.keep for i, r in enumerate(q.classify(docs, own).collect())}
        assert len(out) == len(rows)
        assert all(k for (d, _), k in out.items() if d is not None and d < 60) and not any(k for (d, _), k in out.items() if d is not None and 100 <= d < 110)
    assert q.classify(docs.limit(0), labels).count() == 0


def planted(n, gold, rng):
    """Votes of independent labellers on n documents of which 30 % are to be rejected, truth, and the labellers' rates."""
    truth = rng.rand(n) < 0.3
    fires = np.array([[0.02, 0.1, 0.01, 0.05, 0.03], [0.7, 0.5, 0.3, 0.6, 0.4]])
    votes = np.where(rng.rand(n, 5) < fires[truth.astype(int)], q.REJECT, q.NOTHING)
    label = np.where(rng.rand(n) < gold, np.where(rng.rand(n) < 0.95, truth, ~truth), q.NOTHING)
    return np.c_[votes, label], truth, fires


@pytest.mark.parametrize("gold", [0, 0.3])
def test_em_finds_propensities_and_accuracies(gold):
    votes, truth, fires = planted(200_000, gold, np.random.RandomState(0))
    patterns, back, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, prior, rates, label_rates = q.em(patterns, n.astype(float))
    assert np.abs(rates - fires).max() < 0.02 and abs(prior - 0.3) < 0.02
    if gold:
        assert np.abs(label_rates - [0.05, 0.95]).max() < 0.02
    each = post[back.ravel()]
    assert np.mean((each > 0.5) == truth) > 0.9
    for lo in np.arange(0, 1, 0.2):  # posteriors are the shares that are to be rejected
        own = (each >= lo) & (each < lo + 0.2)
        assert own.sum() < 2000 or abs(truth[own].mean() - each[own].mean()) < 0.03


def test_em_by_brute_force():
    """Document by document, with plain loops, until nothing moves."""
    votes, _, _ = planted(400, 0.3, np.random.RandomState(2))
    free = 1 / (1 + sum(v[-1] != q.NOTHING for v in votes) / q.HALVED)
    counts = np.array([free if v[-1] == q.NOTHING else 1.0 for v in votes])
    post = [0.95 if v[-1] == q.REJECT else 0.05 if v[-1] == q.KEEP else 0.8 if q.REJECT in v[:-1] else 0.05 for v in votes]
    for _ in range(3000):
        weight = [counts * (1 - np.array(post)), counts * np.array(post)]
        chance = []
        for c in (0, 1):
            own = [(sum(w for w, v in zip(weight[c], votes) if v[j] == q.REJECT) + 0.5) / (sum(weight[c]) + 1) for j in range(5)]
            said = [(w, v[-1]) for w, v in zip(weight[c], votes) if v[-1] != q.NOTHING]
            label = (sum(w for w, x in said if x == q.REJECT) + 0.5) / (sum(w for w, _ in said) + 1)
            label = min(label, q.LABEL_ERROR) if c == 0 else max(label, 1 - q.LABEL_ERROR)
            share = (sum(weight[1]) + 0.5) / (sum(counts) + 1)
            like = np.full(len(votes), share if c else 1 - share)
            for i, v in enumerate(votes):
                for j in range(5):
                    like[i] *= own[j] if v[j] == q.REJECT else 1 - own[j]
                like[i] *= label if v[-1] == q.REJECT else 1 - label if v[-1] == q.KEEP else 1
            chance.append(like)
        new = chance[1] / (chance[0] + chance[1])
        moved, post = np.abs(new - post).max(), list(new)
        if moved < 1e-8:
            break
    patterns, back, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    assert np.allclose(q.em(patterns, n.astype(float))[0][back.ravel()], post, atol=1e-5)


def test_scorer_learns():
    rng = np.random.RandomState(1)
    places = rng.randint(1, 50, (400, 6))
    target = (places == 7).any(1).astype(float)
    group = (places.ravel(), np.arange(401) * 6, np.ones(400))
    w, b = q.train([group], target)
    again, _ = q.train([group], target, chunk=37)  # in chunks the same
    assert np.allclose(w, again, atol=1e-5)
    assert np.mean(((w[places].sum(1) + b) > 0) == target) > 0.98
