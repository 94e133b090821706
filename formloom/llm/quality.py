"""Quality classifier from weak labels.

Heuristic labellers vote to reject a document or abstain; labels of people, where there are any, are one more labeller. Documents are of
two unseen classes. A heuristic votes with one probability on documents to reject (its propensity) and with another on the rest (its
rate of false alarms), and both what it says and that it abstains count. Labels are missing at random: only what they say counts, with
an accuracy for either class. Expectation maximisation over the counts of all documents' vote patterns estimates these probabilities and the
share to reject, and gives each pattern a posterior. A hashed linear scorer is then trained on posterior labels, and decides on every document.

Heuristics: shares of symbol runs, table bars, upper-case words, shouted words, words that repeat the one before, repeated lines and
characters other than letters; and a lexicon of words and word beginnings, learned from labelled documents, that
mark toxic ones. The labels themselves reject where they say low quality or toxic. The scorer sees no labels, only the text.

Bounds, all arguments: the lexicon is learned on `labelled` labelled documents, the scorer on `trained` documents, each those of smallest
hash, as far as `sample_bytes` of text go (documents above a 64th of that are not taken into samples); votes, posteriors and scores cover all
documents. There are at most 2^8 * 3 vote patterns. The lexicon is counted by aggregates; the driver holds the samples' sketches of words,
and the scorer's features, a number each.

A null text counts as an empty one; texts without words get no votes but a label's, and are decided like any other. Rows with null
ids have no labels; of several labels of an id the worst counts. Of rows with one id and different texts, each is scored, and the posterior of the
worst is what any of them is trained on. Without labels there is no lexicon. Equal hashes are taken in order of ids. Columns other than
id and text are not looked at. A table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Scratch

LABELLED, TRAINED, SAMPLE_BYTES = 8192, 8192, 1 << 26
BITS, EPOCHS, L2 = 22, 80, 1e-5
#: Lexicon entries: documents of the sample they are in at least, and the share of those that is toxic.
SUPPORT, PRECISION = 5, 0.9
#: The same for entries of which one is enough; else a document must have two.
ENOUGH_SUPPORT, ENOUGH_PRECISION = 20, 0.98
#: Sketch values that near copies share, of how many.
ALIKE = (5, 8)
#: Share above which a labeller rejects.
SHARES = {"symbols": 0.2, "bars": 0.15, "capitals": 0.4, "shouts": 0.3, "repeats": 0.25, "lines": 0.6, "others": 0.6}
#: Votes. Labels that are wrong more often than LABEL_ERROR are not believed to be.
REJECT, KEEP, NOTHING, LABEL_ERROR = 1, 0, 2, 0.2
#: With so many labelled documents, one without a label weighs half of one that has one.
HALVED = 100
#: Features of a share are its level among these.
LEVELS = (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8)
#: Values of features: of a document's words together, of length one times this; of each share.
WORDS_NORM, SHARE_VALUE = 2.0, 3.0
#: Words that a worker remembers.
REMEMBERED = 200_000


def texts_of(column, few: int = 256):
    """The texts of a column as bytes, of which only a few are held at a time."""
    import pyarrow as pa

    for at in range(0, len(column), few):
        yield from column.slice(at, few).cast(pa.binary()).to_pylist()


#: Bytes of letters, white space, and whatever is not ASCII.
LETTERS = bytes(b for b in range(256) if b >= 128 or chr(b).isalpha() or chr(b).isspace())


def shares(text: bytes) -> dict[str, float]:
    """What the labellers look at, each from 0 to 1; empty for a text without words."""
    import operator
    import re

    words = text.split()
    if not words:
        return {}
    n, lines = len(words), [x for x in text.split(b"\n") if x.strip()]
    plain = text.translate(None, LETTERS)
    own = {
        "symbols": len(re.findall(rb"[#$%&*^~=<>{}\\/_+@]{2,}", text)) / n,
        "bars": words.count(b"|") / n,
        "capitals": sum(map(bytes.isupper, words)) / n,
        "shouts": text.count(b"!!") / n,
        "repeats": sum(map(operator.eq, words, words[1:])) / n,
        "lines": 1 - len(set(lines)) / len(lines),
        "others": len(plain) / len(text),
    }
    return {k: min(1.0, v) for k, v in own.items()}


def vocabulary(text: bytes) -> set[bytes]:
    """Distinct lower-cased words without punctuation around them."""
    return {w.strip(b"\"'()[].,;:!?#$%&*|") for w in set(text.lower().split())} - {b""}


def forms(word: bytes) -> list[bytes]:
    """A word and its beginnings of four and five letters."""
    if word.isascii():
        n = len(word)
        return [b"w:" + word, b"4:" + word[:4], b"5:" + word[:5]] if n > 4 else [b"w:" + word, b"4:" + word] if n == 4 else [b"w:" + word]
    text = word.decode("utf-8", "replace")
    return [b"w:" + word] + [b"%d:" % n + text[:n].encode() for n in (4, 5) if len(text) >= n]


def votes(text: bytes, marks: Marks) -> list[int]:
    """Votes of the share labellers and of the lexicon."""
    own = shares(text)
    if not own:
        return [NOTHING] * (len(SHARES) + 1)
    out = [REJECT if own[k] > most else NOTHING for k, most in SHARES.items()]
    return out + [REJECT if marks.lexicon and marks.of(vocabulary(text)) >= 2 else NOTHING]


def em(patterns, counts, rounds: int = 2000):
    """(posterior of reject by vote pattern, share to reject, rates, label rates). Columns of patterns are labellers, the last one the labels.
    rates[c, j]: how often heuristic j rejects documents of class c (1: to reject); label rates[c]: how often labels that are there do.
    Documents without a label weigh 1 / (1 + labelled documents / HALVED) in the estimates: all count as long as there are few labels, and with many
    the rates are not bent by labellers that are not independent. Rates have half a document of either vote added, so that none is 0 or 1."""
    import numpy as np

    fires, label = (patterns[:, :-1] == REJECT).astype(np.float64), patterns[:, -1]
    says = np.stack([label == KEEP, label == REJECT], 1).astype(np.float64)
    weights = np.where(label == NOTHING, 1 / (1 + counts[label != NOTHING].sum() / HALVED), 1.0) * counts
    post = np.where(label == REJECT, 0.95, np.where(label == KEEP, 0.05, np.where(fires.any(1), 0.8, 0.05)))
    rates, label_rates, prior = np.zeros((2, fires.shape[1])), np.zeros(2), 0.5
    for _ in range(rounds):
        each = np.stack([1 - post, post]) * weights
        rates = (each @ fires + 0.5) / (each.sum(1)[:, None] + 1)
        said = each @ says
        label_rates = (said[:, 1] + 0.5) / (said.sum(1) + 1)
        label_rates = np.array([min(label_rates[0], LABEL_ERROR), max(label_rates[1], 1 - LABEL_ERROR)])
        prior = (each[1].sum() + 0.5) / (weights.sum() + 1)
        log = np.log(rates) @ fires.T + np.log1p(-rates) @ (1 - fires).T + np.log(label_rates)[:, None] * says[:, 1] + np.log1p(-label_rates)[:, None] * says[:, 0]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1] + np.log1p(-prior) - np.log(prior), -700, 700)))
        moved, post = np.abs(new - post).max(initial=0), new
        if moved < 1e-10:
            break
    return post, prior, rates, label_rates


def sketch(vocab: set[bytes]) -> list[int]:
    """Smallest hashes of the words under ALIKE[1] permutations; near copies have most of them in common."""
    import numpy as np
    from xxhash import xxh64_intdigest

    h = np.array([xxh64_intdigest(w, 3) for w in vocab], np.uint64)
    turns = np.arange(1, ALIKE[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    return [int((h * t).min() >> np.uint64(1)) if len(h) else 0 for t in turns]


class Marks(dict):
    """What words count for in the lexicon; those met lately are remembered."""

    def __init__(self, lexicon: dict[bytes, int]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: bytes) -> int:
        own = max(self.lexicon.get(f, 0) for f in forms(word))
        if len(word) <= 48 and len(self) < REMEMBERED:
            self[word] = own
        return own

    def of(self, vocab: set[bytes]) -> int:
        """2 is enough."""
        return sum(map(self.__getitem__, vocab)) if self.lexicon else 0


def copies(sketches) -> set[int]:
    """Of (id, sketch) in order: ids whose sketch shares ALIKE[0] values with that of an earlier one that is no copy."""
    met: dict = {}
    out = set()
    for own, sketched in sketches:
        shared: dict[int, int] = {}
        for key in enumerate(sketched):
            for other in met.get(key, ()):
                shared[other] = shared.get(other, 0) + 1
        if max(shared.values(), default=0) >= ALIKE[0]:
            out.add(own)
        else:
            for key in enumerate(sketched):
                met.setdefault(key, []).append(own)
    return out


def lexicon_of(found: DataFrame) -> dict[bytes, int]:
    """Words and beginnings that mark toxic documents, with what one counts for; near copies count once. found: id, toxic, words, sketch."""
    again = copies((r.id, r.sketch) for r in found.select("id", "sketch").orderBy("id").toLocalIterator())
    own = found.select("id", "toxic", "words")
    if again:
        own = own.join(F.broadcast(found.sparkSession.createDataFrame([(i,) for i in sorted(again)], "id long")), "id", "left_anti")

    def counted(batches):
        import pyarrow as pa

        for b in batches:
            n: dict[bytes, list[int]] = {}
            for bad, words in zip(b.column(1).to_pylist(), b.column(2)):
                for f in {f for w in words.as_py() for f in forms(w)}:
                    own = n.setdefault(f, [0, 0])
                    own[0] += bad
                    own[1] += 1
            cols = [pa.array(n, pa.binary()), pa.array((x for x, _ in n.values()), pa.int64()), pa.array((x for _, x in n.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["form", "toxic", "n"])

    parts = own.mapInArrow(counted, "form binary, toxic long, n long")
    counts = parts.groupBy("form").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).where((F.col("toxic") >= SUPPORT) & (F.col("toxic") >= PRECISION * F.col("n")))
    enough = (F.col("toxic") >= ENOUGH_SUPPORT) & (F.col("toxic") >= ENOUGH_PRECISION * F.col("n"))
    return {bytes(r.form): 2 if r.enough else 1 for r in counts.select("form", enough.alias("enough")).collect()}


class Hashing(dict):
    """Places of a word's features."""

    def __missing__(self, word: bytes) -> list[int]:
        from xxhash import xxh64_intdigest

        own = [xxh64_intdigest(f, 7) >> (64 - BITS) for f in forms(word)]
        if len(word) <= 48 and len(self) < REMEMBERED:
            self[word] = own
        return own


def share_places(text: bytes, marked: int | None) -> list[int]:
    """Places of the features of a text's shares, and of what its words count for in the lexicon (None without one)."""
    from xxhash import xxh64_intdigest

    own = {k: sum(v > x for x in LEVELS) for k, v in shares(text).items()}
    if marked is not None:
        own["lexicon"] = min(4, marked)
    return [xxh64_intdigest(f"s:{k}:{v}".encode(), 7) >> (64 - BITS) for k, v in own.items()]


def train(groups, target, chunk: int = 1 << 13):
    """Weights and bias of a logistic scorer, by full-batch steps scaled per feature. groups: (places, starts, values), the places of all features
    document by document, where documents start there (and the end), and the value that all of a document's features have. Documents
    are gone through in chunks, so that little more than the places is held."""
    import numpy as np

    docs, known = len(target), np.zeros(1 << BITS, bool)
    for places, _, _ in groups:
        known[places] = True
    used = np.flatnonzero(known)
    number = np.zeros(1 << BITS, np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    groups = [(number[places], starts, values) for places, starts, values in groups]
    w, b = np.zeros(len(used)), 0.0
    sq, sqb = np.full(len(used), 1e-8), 1e-8
    for _ in range(EPOCHS):
        g, gb = L2 * w, 0.0
        for lo in range(0, docs, chunk):
            hi = min(docs, lo + chunk)
            z = np.full(hi - lo, b)
            for idx, starts, values in groups:
                sums = np.concatenate([[0.0], np.cumsum(w[idx[starts[lo] : starts[hi]]])])
                z += (sums[starts[lo + 1 : hi + 1] - starts[lo]] - sums[starts[lo:hi] - starts[lo]]) * values[lo:hi]
            err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target[lo:hi]) / docs
            for idx, starts, values in groups:
                g += np.bincount(idx[starts[lo] : starts[hi]], np.repeat(err * values[lo:hi], np.diff(starts[lo : hi + 1])), minlength=len(used))
            gb += err.sum()
        sq, sqb = sq + g * g, sqb + gb**2
        w, b = w - 0.2 * g / np.sqrt(sq), b - 0.2 * gb / sqb**0.5
    full = np.zeros(1 << BITS, np.float32)
    full[used] = w
    return full, b


def _starts(lengths):
    import numpy as np

    return np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)])


def features(sample):
    """Groups of features for `train` and targets, of a table (reject, words, shape). Features of fewer than 3 documents are left out."""
    import numpy as np

    if not sample.num_rows:
        return [], np.empty(0)
    words, shapes = sample["words"].chunk(0), sample["shape"].chunk(0)
    n, places = words.value_lengths().to_numpy(), words.flatten().to_numpy()
    often = np.bincount(places, minlength=1 << BITS)[places] >= 3
    kept = np.concatenate([np.zeros(1, np.int64), np.cumsum(often)])
    starts = kept[_starts(n)]
    return [
        (places[often], starts, WORDS_NORM / np.sqrt(np.maximum(1, n))),
        (shapes.flatten().to_numpy(), _starts(shapes.value_lengths().to_numpy()), np.full(len(n), SHARE_VALUE)),
    ], sample["reject"].to_numpy()


def _sampled(rows: DataFrame, ids: DataFrame, sample_bytes: int, run, schema: str, scratch: Scratch, name: str) -> DataFrame:
    """What `run` makes (id, size and more) of the rows with these ids, of which there are as few as a sample has: those of smallest hash, as far as
    sample_bytes go."""
    own = rows.where(F.octet_length("text") <= sample_bytes // 64).join(F.broadcast(ids), "id")
    made = scratch.save(own.mapInArrow(run, schema), name)
    running = F.sum("size").over(Window.orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0))
    within = made.groupBy("id").agg(F.sum("size").alias("size")).withColumn("_running", running).where(F.col("_running") <= sample_bytes)
    return made.join(F.broadcast(within.select("id")), "id")


def classify(
    df: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, carry: list[str] | None = None,
    labelled: int = LABELLED, trained: int = TRAINED, sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """(id, score, keep) of every row: the scorer's probability that it is fit, and the decision. carry: columns of `df` to
    return instead of the id alone; any named score or keep are replaced."""
    import numpy as np

    spark = df.sparkSession
    scratch, sent = Scratch(spark, "quality"), spark.sparkContext.broadcast
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if labels is None:
        labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    low = F.max((F.coalesce("quality", F.lit(1)) == 0).cast("int"))
    labels = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(low.alias("low"), F.max(F.coalesce("toxic", F.lit(0))).cast("int").alias("toxic"))
    labels = scratch.save(labels, "labels")

    def words(batches):
        import pyarrow as pa

        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            own = [vocabulary(x) for x in texts]
            cols = [pa.array(map(len, texts), pa.int64()), b.column(2), pa.array(map(sorted, own), pa.list_(pa.binary())), pa.array(map(sketch, own), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["id", "size", "toxic", "words", "sketch"])

    ids = labels.orderBy(F.xxhash64("id"), "id").limit(labelled).select("id", "toxic")
    lexicon = sent(lexicon_of(_sampled(rows, ids, sample_bytes, words, "id long, size long, toxic int, words array<binary>, sketch array<long>", scratch, "words")))

    def voted(batches):
        import pyarrow as pa

        marks = Marks(lexicon.value)
        for b in batches:
            own = [sum(v * 3**i for i, v in enumerate(votes(x, marks))) for x in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.int32())], ["id", "pattern"])

    labellers = len(SHARES) + 2
    verdict = F.when(F.col("low").isNull(), NOTHING).otherwise(F.greatest("low", "toxic"))
    cast = rows.mapInArrow(voted, "id long, pattern int").join(labels, "id", "left")
    cast = scratch.save(cast.select("id", (F.col("pattern") + verdict * 3 ** (labellers - 1)).cast("int").alias("pattern")), "votes")
    counts = sorted(map(tuple, cast.groupBy("pattern").count().collect()))
    codes = np.array([p for p, _ in counts], np.int64)
    post, *_ = em((codes[:, None] // 3 ** np.arange(labellers)) % 3, np.array([n for _, n in counts], np.float64))
    posts = spark.createDataFrame([(int(p), float(x)) for p, x in zip(codes, post)], "pattern int, reject double")
    judged = cast.join(F.broadcast(posts), "pattern").select("id", "reject")
    least = judged.where("id is not null").groupBy("id").agg(F.max("reject").alias("reject"))
    picked = scratch.save(least.orderBy(F.xxhash64("id"), "id").limit(trained), "picked")

    def featured(batches):
        import pyarrow as pa

        known, marks = Hashing(), Marks(lexicon.value)
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            own = [(x, vocabulary(x)) for x in texts]
            placed = pa.array(([p for w in sorted(v) for p in known[w]] for _, v in own), pa.list_(pa.int32()))
            shape = pa.array((share_places(x, marks.of(v) if marks.lexicon else None) for x, v in own), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, texts), pa.int64()), b.column(2), placed, shape], ["id", "size", "reject", "words", "shape"])

    sample = _sampled(rows, picked, sample_bytes, featured, "id long, size long, reject double, words array<int>, shape array<int>", scratch, "features")
    model = sent(train(*features(sample.select("reject", "words", "shape").toArrow().combine_chunks())))

    def scored(batches):
        import pyarrow as pa

        w, bias = model.value

        class Weights(dict):
            """Of a word: the sum of its features' weights, their number, and what it counts for in the lexicon."""

            def __missing__(self, word):
                own = [float(w[xxh64_intdigest(f, 7) >> (64 - BITS)]) for f in forms(word)]
                own = sum(own), len(own), marks[word]
                if len(word) <= 48 and len(self) < REMEMBERED:
                    self[word] = own
                return own

        from math import fsum  # the same in any order

        from xxhash import xxh64_intdigest

        marks = Marks(lexicon.value)
        known = Weights()
        for b in batches:
            score = []
            for x in texts_of(b.column(b.num_columns - 1)):
                own = list(map(known.__getitem__, vocabulary(x)))
                words = fsum(o[0] for o in own) * WORDS_NORM / max(1, sum(o[1] for o in own)) ** 0.5
                places = share_places(x, sum(o[2] for o in own) if marks.lexicon else None)
                z = words + SHARE_VALUE * float(sum(w[p] for p in places)) + bias
                score.append(float(1 / (1 + np.exp(np.clip(z, -40, 40)))))
            own = np.array(score, np.float64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(own), pa.array(own >= threshold)], [*b.schema.names[:-1], "score", "keep"])

    carried = [c for c in carry or [id_col] if c not in ("score", "keep")]
    given = df.select(*carried, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    schema = given.drop("_text").withColumn("score", F.lit(0.0)).withColumn("keep", F.lit(True)).schema
    return given.mapInArrow(scored, schema)
