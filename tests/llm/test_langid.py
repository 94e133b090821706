import functools
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from formloom.llm import langid, queries


@functools.cache
def sign(code):
    return np.random.RandomState((langid.SEED * 1_000_003 + code) % (1 << 32)).choice(np.float32([-1, 1]), langid.D)


def brute_vector(text):
    s = [0]
    for c in (text or "").lower():
        x = ord(c) if c.isalpha() else 0
        if x or s[-1]:
            s.append(x)
    if s[-1]:
        s.append(0)
    grams = Counter(zip(s, s[1:], s[2:]))
    return sum((n * np.roll(sign(a), 2) * np.roll(sign(b), 1) * sign(c) for (a, b, c), n in grams.items()), np.zeros(langid.D))


def test_held_out_accuracy_and_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    out = {r.doc_id: r for r in queries.op10_langid(spark, sf).collect()}
    assert len(out) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(out[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([out[r.doc_id].lang_pred == r.lang for r in held]) > 0.9
    protos = {}
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.doc_id < 10**9 and len(r.text) < 10**9:
            protos.setdefault(r.lang, []).append(r.text)
    sample = sorted(rows, key=lambda r: len(r.text))[:20]
    learned = {k: sum(brute_vector(t) for t in v) for k, v in protos.items()}
    for r in sample:
        v = brute_vector(r.text)
        cos = {k: float(v @ p / (np.linalg.norm(v) * np.linalg.norm(p))) for k, p in learned.items()}
        best = max(sorted(cos), key=cos.get)
        assert out[r.doc_id].lang_pred == best and abs(out[r.doc_id].score - max(0, cos[best])) < 1e-9


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(langid, "SLICE", 100)
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "", None), (5, "12 34 !!", "en"),
            (6, "the" + " . " * 200 + "dog", None), (None, "le chien", "fr"), (7, "日本語のテキスト 😀" * 50, "ja"), (8, "the cat " * 5000, "en"), (8, "the cat " * 5000, "en"),
            (9, "".join(chr(0x4E00 + i % 900) for i in range(3000)), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    protos = langid.learn(df)
    assert set(protos) == {"en", "fr", "ja"}
    want = {k: sum(brute_vector(t) for _, t, l in rows if l == k and t is not None) for k in protos}
    assert all(np.array_equal(protos[k], want[k]) for k in protos)
    out = langid.predict(df, protos, keep=("doc_id",)).collect()
    assert [r.lang_pred for r in sorted(out, key=str) if r.doc_id in (3, 4, 5)] == ["und"] * 3
    assert {r.doc_id: r.lang_pred for r in out if r.doc_id in (6, None, 7)} == {6: "en", None: "fr", 7: "ja"}
    assert all(0 <= r.score <= 1 for r in out) and len(out) == len(rows)
    assert langid.learn(df.limit(0)) == {} and {r.lang_pred for r in langid.predict(df, {}, keep=("doc_id",)).collect()} == {"und"}
