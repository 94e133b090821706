import hashlib
import random
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from formloom.llm import order_minhash as om


def h_long(*xs):
    seed = 42
    for x in xs:
        seed = xxhash.xxh64_intdigest((x & (1 << 64) - 1).to_bytes(8, "little"), seed)
    return seed


def h_int(seed, x):
    return xxhash.xxh64_intdigest((x & (1 << 32) - 1).to_bytes(4, "little"), seed)


def brute(text):
    """Sketches from all k-mers and occurrences, by the definition; hashes are those of the module."""
    seen, items, bits = Counter(), [], lambda h: h >> 29 & (1 << 34) - 1
    for i in range(max(len(text) - om.K, 0) + 1 if text else 0):
        kmer = text[i : i + om.K]
        seen[kmer] += 1
        place = bits(xxhash.xxh64_intdigest(kmer.encode("utf-32-be"), 42))
        if seen[kmer] > 1:
            place = bits(h_int(h_long(place), seen[kmer]))
        items.append(((place & 63) << 28 | place >> 6, i))
    kept = [sorted(x for x in items if x[0] >> 28 == b)[: om.TUPLE] for b in range(om.SKETCHES)]
    out = []
    for b in range(om.SKETCHES) if items else ():
        around = [x for c in range(om.SKETCHES) for x in kept[(b + c) % om.SKETCHES]][: om.TUPLE]
        out.append(h_long(*(p for p, _ in sorted(around, key=lambda x: x[1]))) >> 32 | 1)
    return out or [0] * om.SKETCHES


def like(a, b):
    return sum(1 for x, y in zip(a, b) if x == y) / om.SKETCHES


def brute_rows(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        a, b, c = brute(t), brute(e), brute(nxt)
        hexes = lambda s: "".join(f"{x:08x}" for x in s)
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), hexes(a), hexes(b), like(a, b), like(a, c)))
    return sorted(out, key=str)


COLS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def got(df):
    return sorted((tuple(r) for r in df.select(COLS).collect()), key=str)


def test_matches_brute_force(spark, sf, monkeypatch):
    monkeypatch.setattr(om, "RANGE", 16)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = sorted(rows, key=lambda r: len(r[1]))[:80]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(om.compared(df)) == brute_rows(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(om, "RANGE", 3)
    rng = random.Random(5)
    rows = [(5, None), (6, ""), (-4, "short"), (7, "ünï😀" * 40), (8, "a" * 3000), (9, "line one\n" * 700), (1 << 60, "x"), (7, "twice"), (7, "twice"),
            (12, "".join(rng.choice("abcdé ") for _ in range(5000))), (13, "exactly12chr"), (None, "no id"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sig", F.lit("clash")).withColumn("id", F.lit("clash"))
    assert got(om.compared(df)) == brute_rows(rows)
    assert om.compared(df.limit(0)).count() == 0
    assert got(om.compared(df.where("doc_id = 12"))) == brute_rows([r for r in rows if r[0] == 12])
    assert got(om.compared(df.where("doc_id is null"))) == brute_rows([r for r in rows if r[0] is None])
    prints = {r.fingerprint for r in om.fingerprints(df.where("doc_id = 7 and text = 'twice'")).collect()}
    assert len(prints) == 1


def test_likeness_follows_edits(spark):
    rng = random.Random(6)
    base = [rng.choice("abcdefgh ") for _ in range(4000)]
    edits = []
    for n in (0, 10, 60, 300, 4000):
        t = list(base)
        for i in rng.sample(range(4000), n):
            t[i] = "z"
        edits.append("".join(t))
    half = "".join(base[2000:] + base[:2000])
    sig = [brute(t) for t in edits]
    near = [like(sig[0], s) for s in sig]
    assert near[0] == 1 and near == sorted(near, reverse=True) and near[1] > 0.7 > near[3] and near[4] < 0.1
    assert 0.3 < like(sig[0], brute(half)) < 0.7  # the same k-mers in another order
    df = spark.createDataFrame([(t,) for t in edits], "text string")
    assert [r.fingerprint for r in om.fingerprints(df).collect()] == ["".join(f"{x:08x}" for x in s) for s in sig]


def test_repeats_and_short_texts(spark):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    rest, passage, sentence, short = text(300), text(80), "an old sentence that is said again and again. ", text(60)
    texts = [rest + passage * n for n in (1, 2, 10, 30)] + [sentence * 20, sentence * 2000, short, short[:50] + "zz" + short[52:], text(60)]
    texts += ["a" * 3000, "ab" * 70, "short", "exactly12chr", "exactly13chrs", "", text(4000), text(700) * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    got = [r.fingerprint for r in om.fingerprints(df).orderBy("id").collect()]
    sig = [brute(t) for t in texts]
    assert got == ["".join(f"{x:08x}" for x in s) for s in sig]
    assert all(all(s) for t, s in zip(texts, sig) if t)
    assert like(sig[1], sig[2]) < 0.5 and like(sig[1], sig[3]) < 0.3 and like(sig[4], sig[5]) < 0.1
    assert like(sig[6], sig[7]) > 0.25 and like(sig[6], sig[8]) < 0.1


def test_no_python_in_the_plan(spark, sf):
    plan = om.compared(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
