"""Language-model scores by stupid backoff over n-grams of words, computed with tables of counts that are dealt to parts.

Counts c leave the scored document out: they are those of the corpus less the document's own, so a text's n-grams are no evidence for
themselves. A word's score after its context, the up to `order` - 1 words before it, is log10(c(context and word) / c(context)) if these words in a
row occur at all elsewhere (c > 0); else the context loses its first word, at a cost of log10(BACKOFF). Without context the score is
log10(c(word) / N), and of a word that no other document has log10(BACKOFF / N); N: words of the other documents, 1 at least.
A document begins with a start mark, and contexts do not reach beyond it. A document's score is the sum over its words. Words are lower-cased
(A-Z) and split at white space. Words are told apart by 64-bit hashes and n-grams by 64-bit hashes of these:
among 2 billion different n-grams one pair is expected to collide once in nine corpora.

1. Explode: each task reads its documents in blocks and lists each block's distinct n-grams of all orders with their counts in the block. A
   frequent n-gram is thus one entry a block, so no part of the table is dominated by one key, and no table is sent to the driver or to all tasks.
2. Count and join: the entries are dealt to parts of the count table by hash. A part sums the counts over all blocks and joins them to the
   entries of the blocks. The number of words and of documents are counted in the same way, as two further keys. The number of parts follows from
   the size of the texts.
3. Sum: each block works out its n-grams again from its numbered words, puts the counts in place, and sums its documents' scores.

Entries of a block for a part travel as one row, sorted and packed: n-grams as rows of their own (hash and row id) take 3.0 times the input to
shuffle once, and the count table 1.7 times, measured, where all that is shuffled here is 3.4 times the input.

A null or empty text has no words: score 0 and a null mean. Rows with null or repeated ids are scored each, and are documents each. Columns other
than id and text are not looked at. A table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words are numbered 1 to CLASSES - 1 by their hash; START is the mark before the first.
CLASSES, START = 1 << 64, 0
BACKOFF = 0.4
#: Bytes of text for each part of the count table, and the fewest parts; documents and words of a block.
PART, PARTS = 1 << 24, 64
BLOCK_DOCS, BLOCK_WORDS = 4096, 1 << 20


class Classes(dict):
    """Hashes of words; those met lately are remembered."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        own = 1 + xxh64_intdigest(word, 42) % (CLASSES - 1)
        if len(word) <= 48 and len(self) < self.LIMIT:
            self[word] = own
        return own

    def of(self, text: bytes | None):
        import numpy as np

        return np.fromiter(map(self.__getitem__, (text or b"").lower().split()), np.uint64)


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def _binary(column):
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()


def _mixed(a, b):
    """Hashes of pairs of hashes."""
    import numpy as np

    x = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b + np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _total_key():
    """The key under which all words are counted: no start mark follows another."""
    import numpy as np

    return _mixed(np.array([START], np.uint64), np.array([START], np.uint64))


def _grams(keys, numbers, n, order: int):
    """A block's n-grams. keys: of its words; numbers: its words' places there, with a start mark (place 0) before each document that has
    words; n: words of these documents. Per order: places of the grams' last words, the grams' numbers, and the distinct grams' keys and counts."""
    import numpy as np

    at = np.arange(len(numbers)) - np.repeat(np.cumsum(n + 1) - (n + 1), n + 1)
    where, own, key = np.arange(len(numbers)), numbers.astype(np.int64), keys
    out = [(where, own, key, np.bincount(own, minlength=len(keys)))]
    for length in range(2, order + 1):
        place = np.full(len(numbers), -1, np.int64)
        place[where] = own
        where = np.flatnonzero(at >= length - 1)
        both, own, count = np.unique(place[where - 1] * len(keys) + numbers[where], return_inverse=True, return_counts=True)
        key = _mixed(key[both // len(keys)], keys[both % len(keys)])
        out.append((where, own, key, count))
    return out


def _dealt(grams, parts: int):
    """Keys of all orders and of the total, their order when dealt (parts are ranges of keys), and their parts then."""
    import numpy as np

    keys = np.concatenate([_total_key(), *(g[2] for g in grams)])
    order = np.argsort(keys, kind="stable")
    part = ((keys[order] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return keys, order, part.astype(np.int64)


def word_scores(grams, counts, total: int, n):
    """Scores of a block's words, start marks left out. counts: per order, of its distinct grams in the corpus; total: words there; n: words of
    the block's documents that have some."""
    import numpy as np

    size = len(grams[0][0])
    doc = np.repeat(np.arange(len(n)), n + 1)
    elsewhere = []
    for (where, own, key, _), c in zip(grams, counts):
        _, back, here = np.unique(doc[where] * len(key) + own, return_inverse=True, return_counts=True)
        elsewhere.append(np.zeros(size, np.int64))
        elsewhere[-1][where] = c[own] - here[back]
    there = np.ones(size, bool)
    there[np.cumsum(n + 1) - (n + 1)] = False  # start marks
    out, open_, cost = np.zeros(size), there.copy(), np.zeros(size)
    for length in range(len(grams), 1, -1):
        where = grams[length - 1][0]
        c, context = elsewhere[length - 1][where], elsewhere[length - 2][where - 1]
        seen = (c > 0) & open_[where]
        out[where[seen]] = np.log10(c[seen] / context[seen]) + cost[where[seen]]
        open_[where[seen]] = False
        cost[where] += np.log10(BACKOFF)
    others = np.maximum(total - n, 1)[doc]
    c = elsewhere[0][open_]
    out[open_] = np.log10(np.where(c > 0, c, BACKOFF) / others[open_]) + cost[open_]
    return out[there]


def _packed(numbers) -> bytes:
    """Most numbers are small: bytes of one weight are stored together, and compressed."""
    import numpy as np
    import pyarrow as pa

    width = 4 if not len(numbers) or int(numbers.max()) < 1 << 32 else 8
    planes = np.ascontiguousarray(numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return np.array([width, len(numbers)], np.int64).tobytes() + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes):
    import numpy as np
    import pyarrow as pa

    width, size = np.frombuffer(raw, np.int64, 2).tolist()
    planes = np.frombuffer(pa.decompress(raw[16:], width * size, codec="zstd", asbytes=True), np.uint8).reshape(width, size)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.uint64)


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """(id, n_words, score, mean_score) of every row; order: words of the longest n-grams that are counted."""
    import numpy as np

    texts = _texts(df, id_col, text_col)
    parts = max(PARTS, -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART))

    def blocks(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        classes, block = Classes(), TaskContext.get().partitionId() << 32
        names = ["part", "block", "keys", "counts", "ids", "n", "words"]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

        def out(ids, words):
            n = np.array([len(w) for w in words], np.int64)
            some, mark = n[n > 0], np.array([START], np.uint64)
            stream = np.concatenate([x for w in words if len(w) for x in (mark, w)] or [mark[:0]])
            keys, numbers, count = np.unique(stream, return_inverse=True, return_counts=True)
            ranked = np.argsort(-count, kind="stable")
            ranked = np.r_[ranked[keys[ranked] == START], ranked[keys[ranked] != START]]
            place = np.empty(len(keys), np.int64)
            place[ranked] = np.arange(len(keys))
            keys, numbers = keys[ranked], place[numbers]
            ids = pa.array(ids, pa.int64())
            there = np.array([i is not None for i in ids.to_pylist()], np.uint8)
            head = np.asarray(ids.fill_null(0)).tobytes() + there.tobytes()
            rows = [(-1 - block, block, keys.tobytes(), None, head, n.tobytes(), _packed(numbers))]
            if len(stream):
                grams = _grams(keys, numbers, some, order)
                all_, dealt, part = _dealt(grams, parts)
                all_, many = all_[dealt], np.concatenate([[n.sum()], *(g[3] for g in grams)])[dealt]
                starts = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)]
                for lo, hi in zip(starts[:-1], starts[1:]):
                    gaps = np.diff(all_[lo:hi], prepend=np.uint64(0))  # of sorted keys: smaller than keys
                    rows.append((int(part[lo]), block, _packed(gaps), _packed(many[lo:hi]), None, None, None))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        ids, words, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), _binary(batch.column(1))):
                ids.append(i)
                words.append(classes.of(text))
                size += len(words[-1])
                if len(ids) == BLOCK_DOCS or size >= BLOCK_WORDS:
                    yield out(ids, words)
                    ids, words, size, block = [], [], 0, block + 1
        if ids:
            yield out(ids, words)

    def joined(t):
        """One part: sums its keys' counts and gives each block those of its keys. Heads of blocks pass."""
        import pyarrow as pa

        if t["part"][0].as_py() < 0:
            return t
        raw = [np.cumsum(_unpacked(x), dtype=np.uint64) for x in t["keys"].to_pylist()]
        keys, at = np.unique(np.concatenate(raw), return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, at, np.concatenate([_unpacked(x) for x in t["counts"].to_pylist()]).astype(np.int64))
        ends = np.cumsum([len(x) for x in raw])
        back = [_packed(x) for x in np.split(sums[at], ends[:-1])]
        none = pa.nulls(len(raw), pa.binary())
        return pa.table({"part": t["part"], "block": t["block"], "keys": none, "counts": pa.array(back, pa.binary()), "ids": none, "n": none, "words": none})

    def summed(t):
        import pyarrow as pa

        head = next(i for i, x in enumerate(t["ids"].is_valid().to_pylist()) if x)
        n, raw = np.frombuffer(t["n"][head].as_py(), np.int64), t["ids"][head].as_py()
        some, base = n[n > 0], np.zeros(len(n))
        if len(some):
            keys = np.frombuffer(t["keys"][head].as_py(), np.uint64)
            grams = _grams(keys, _unpacked(t["words"][head].as_py()).astype(np.int64), some, order)
            all_, dealt, _ = _dealt(grams, parts)
            found = [int(i) for i in np.argsort(t["part"].to_numpy(), kind="stable") if i != head]
            counts = np.empty(len(all_), np.int64)
            counts[dealt] = np.concatenate([_unpacked(t["counts"][i].as_py()) for i in found]).astype(np.int64)
            cuts = np.cumsum([1, *(len(g[2]) for g in grams)])
            own = word_scores(grams, [counts[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:])], int(counts[0]), some)
            base = np.bincount(np.repeat(np.arange(len(n)), n), own, minlength=len(n))
        there = np.frombuffer(raw, np.uint8, offset=8 * len(n)).astype(bool)
        mean = np.divide(base, n, out=np.zeros(len(n)), where=n > 0)
        return pa.table({"id": pa.array(np.frombuffer(raw, np.int64, len(n)), mask=~there), "n_words": pa.array(n), "score": pa.array(base), "mean_score": pa.array(mean, mask=n == 0)})

    schema = "part long, block long, keys binary, counts binary, ids binary, n binary, words binary"
    dealt = texts.mapInArrow(blocks, schema).groupBy("part").applyInArrow(joined, schema)
    return dealt.groupBy("block").applyInArrow(summed, "id long, n_words long, score double, mean_score double").withColumnRenamed("id", id_col)
