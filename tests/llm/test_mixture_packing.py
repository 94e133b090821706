import array
import random
import zlib
from collections import defaultdict

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from formloom.llm import mixture, packing, queries

MIXED = ["doc_id", "size", "source_size", "target", "taken"]


def brute_targets(words):
    names = sorted((k for k in words if k is not None), key=lambda k: k.encode()) + [k for k in words if k is None]
    w = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}
    total, done = 1.5 * sum(words.values()), {}
    while len(done) < len(names):
        rest = [k for k in names if k not in done]
        left, ws = total - sum(done.values()), sum(w[k] for k in rest)
        over = [k for k in rest if left * w[k] / ws > 2 * words[k]]
        done |= {k: 2.0 * words[k] for k in over} or {k: left * w[k] / ws for k in rest}
    return done


def check_mix(rows, out):
    words, got, least = defaultdict(int), defaultdict(int), {}
    source = {}
    for d, t, s in rows:
        n = len((t or "").encode().split())
        words[s] += n
        source[d] = s
        if n:
            least[s] = min(n, least.get(s, n))
    want = brute_targets(words)
    assert len(out) == len(rows)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == words[s] and abs(r.target - want[s]) <= 1e-6 * max(1, want[s]) and 0 <= r.taken <= 2 * r.size
        got[s] += r.taken
    for s in words:
        assert abs(got[s] - want[s]) <= max(2 * least.get(s, 0), 0.002 * want[s]) + 1, (s, got[s], want[s])


def test_mix_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = queries.op2_mixture(spark, sf).select(MIXED).collect()
    check_mix([(r.doc_id, r.text, r.source) for r in docs.collect()], out)
    again = queries.op2_mixture(spark, sf).select(MIXED).collect()
    assert sorted(out) == sorted(again)


def test_mix_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(1, 30), rng.choice(["a", "Z", "é", "b", None, ""])) for i in range(400)]
    rows += [(1000 + i, "same words here", "a") for i in range(300)] + [(2000, None, "a"), (2001, "", "only empty"), (2002, "x " * 9000, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("clash") for c in ("size", "n", "k", "before", "key", "bucket", "lam")})
    check_mix(rows, mixture.mix(docs).withColumn("taken", F.col("copies") * F.col("size")).collect())
    assert mixture.mix(docs.limit(0)).count() == 0
    twice = docs.unionByName(docs).withColumn("doc_id", F.when(F.col("doc_id") > 5, F.col("doc_id")))
    assert mixture.mix(twice).count() == 2 * len(rows)


def check_pack(rows, out):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = defaultdict(list)
    for r in out:
        docs[r.doc_id].append(r)
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        own = sorted(docs[d], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 4096)))
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert r.start == 4096 * r.piece and len(part) == r.length and zlib.crc32(array.array("I", part).tobytes()) == r.ids_crc32
    seqs = defaultdict(list)
    for r in out:
        seqs[r.sequence_id].append((r.offset, r.length))
    for spots in seqs.values():
        at = 0
        for o, n in sorted(spots):
            assert o == at
            at += n
        assert at <= 4096
    return len(seqs), sum(r.length for r in out)


def test_pack_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bins, tokens = check_pack(rows, queries.op3_packing(spark, sf).collect())
    assert bins <= 1.03 * tokens / 4096 + 2


def test_pack_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a" * 20000), (4, "Ünï <|endoftext|> é x y z it's 12.5"), (5, "word " * 9000), (6, "b " * 4095), (7, "ΣΑΣ ΟΔΟΣ\x0b\x1cx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("offset", F.lit("clash"))
    check_pack(rows, packing.packed(docs).collect())
    assert packing.packed(docs.limit(0)).count() == 0
    with_ids = packing.packed(docs, with_ids=True).collect()
    assert all(len(r.ids) == r.length for r in with_ids)
    assert packing.packed(docs.withColumn("doc_id", F.lit(None).cast("long"))).count() == len(with_ids)


def test_best_fit_takes_the_fullest_that_fits():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 3, 4, 5, 10, 5, 9)] == [(0, 0), (0, 6), (1, 0), (1, 4), (2, 0), (3, 0), (4, 0)]
    rng = random.Random(2)
    lengths = [min(4096, int(rng.lognormvariate(6, 1)) + 1) for _ in range(20000)]
    fit = packing.BestFit(4096, packing.BINS)
    for n in lengths:
        fit.place(n)
    assert fit.made <= 1.01 * sum(lengths) / 4096 + 5
