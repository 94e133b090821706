import random

from formloom.llm import simhash


def test_copies_that_repeat_a_passage_are_found(spark):
    rng = random.Random(9)
    rows = []
    for g in range(40):
        words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
        rest, passage = words(100), words(30)
        rows += [(2 * g, " ".join(rest + passage * 2)), (2 * g + 1, " ".join(rest + passage * 20))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in simhash.distinct(df).collect()) == [2 * g for g in range(40)]


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_recall_against_the_exact_mode(spark):
    """Texts with copies of a similarity of 0.8 to 0.95. The exact mode is held against all pairs, and the usual one against that."""
    import random

    from formloom.llm import simhash

    rng, texts = random.Random(8), []
    for _ in range(220):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice((8, 20, 60, 150, 400)))]
        texts.append(base)
        for _ in range(rng.choice((1, 1, 2))):
            n, own = len(base) - 4, list(base)
            while True:  # change words as long as the copy stays near
                other = list(own)
                other[rng.randrange(len(other))] = f"x{rng.randrange(10**9)}"
                a, b = shingles(" ".join(base)), shingles(" ".join(other))
                if len(a & b) < 0.8 * len(a | b) or len(a & b) < rng.uniform(0.8, 0.95) * len(a | b):
                    break
                own = other
            texts.append(own if n > 8 else list(base) + ["end"] * (n > 4))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(10_000, ""), (10_001, " "), (10_002, None), (10_003, "W1 w2"), (10_004, "w1  W2")]
    sets = [(i, shingles((t or "").lower())) for i, t in rows]
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if (len(a & b) >= 0.8 * len(a | b)) if a and b else len(a) == len(b):
                root[max(top(i), top(j))] = min(top(i), top(j))
    want = {i for i in root if root[i] == i}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert {r.doc_id for r in simhash.distinct(df, exact=True).collect()} == want
    kept = {r.doc_id for r in simhash.distinct(df).collect()}
    assert want <= kept and len(rows) - len(kept) >= 0.99 * (len(rows) - len(want)) and len(rows) - len(want) > 150
