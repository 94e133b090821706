"""SimHash near-duplicate groups, searched with sharded BK-trees.

A text's fingerprint has 64 bits: a bit is 1 if it is set in over half of the hashes of the text's word
shingles. Near copies differ in few bits. Candidate search:

* Entries with equal fingerprints are one entry.
* Each entry goes to several shards, such that entries within the radius of each other share a shard:
  `block_shards` (exact for small radii: of radius + c blocks at least c are equal, so any c of them make a
  shard) or `anchor_shards` (smallest shingle hashes under several permutations, for wide radii).
* A shard of over TREE entries is cut into chunks. The tree of each chunk is sent to every chunk of that shard,
  so all pairs of chunks meet in some task and no task holds more than two chunks. Smaller shards are one chunk.
* A BK-tree holds a chunk: children are keyed by their Hamming distance to the parent, and a search follows
  only edges whose distance is within the radius of the query's distance to the node.

Of the links that a task finds it returns a spanning forest: that keeps every connection without listing
all pairs of a group. Components of those links are found by star contraction over written tables.

`distinct` is for near copies of a stated similarity: fingerprints are of distinct shingles, shards are the smallest shingle hashes under
ANCHORS permutations, the radius is wide, and pairs that the trees find are linked if their shingle sets are similar enough. Sets of fewer than BOTTOM shingles are compared
whole, larger ones by the BOTTOM smallest hashes of their union: such an estimate links from SURE on, and rules out below UNLIKELY. Entries with a pair in between
go to their shards once more, with their whole sets, which decide. Texts of one similarity s share a shard with probability
1 - (1 - s)^ANCHORS, 0.9997 at 0.8. None of 96 000 simulated pairs at 0.8 (sets of 4 to 270 shingles) differed in more than 26 bits. With
exact=True nothing is estimated or missed: a set's shards are so many of its smallest shingle hashes that similar sets share one for sure, trees
leave no pair out, and whole sets decide; frequent shingles make that dear. Shingles are told apart by 32 bits (64 if exact) and texts by 64: among a
billion different texts two are expected to be taken for equal once in 37 corpora.

Nulls and words: a null text, an empty text and one of white space have no words; their fingerprint is zero,
linked like any other. Rows that repeat are kept as rows. A null id is kept and is never a component's id unless
all ids of the component are null. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import Scratch, components

BITS = 64
#: Entries of two chunks of a shard, which a task holds at most; fewer where pairs are compared by their sets.
TREE, TREE_OF_SETS = 2048, 256
#: Permutations, hashes kept of a set, and radius, of `distinct`; margins above and below the similarity within which estimates don't decide.
ANCHORS, BOTTOM, WIDE, SURE, UNLIKELY = 5, 96, 28, 0.12, 0.14
#: Shards get so many bits that this many random entries are expected in one.
PER_SHARD = 4
#: Words that are hashed at once, so that memory does not grow with a text.
SLICE = 1 << 16


def shingle_hashes(text: bytes, width: int, lower: bool = True):
    """Arrays of the XXH64 (seed 42) of a text's word shingles, in order; a text is hashed a slice at a time."""
    import numpy as np
    from xxhash import xxh64_intdigest as xxh

    words = (text.lower() if lower else text).split()  # bytes: A-Z only, and white space is 20, 09-0D
    if not words:
        return
    if len(words) < width:
        yield np.array([xxh(b" ".join(words), 42)], np.uint64)
        return
    for at in range(0, len(words) - width + 1, SLICE):
        own = words[at : at + SLICE + width - 1]
        yield np.array([xxh(s, 42) for s in map(b" ".join, zip(*(own[i:] for i in range(width))))], np.uint64)


def fingerprint(text: bytes | None, width: int) -> int:
    """The fingerprint as a signed 64-bit number."""
    import numpy as np

    ones, total = np.zeros(BITS, np.int64), 0
    for h in shingle_hashes(text or b"", width):
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(h)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def set_fingerprint(distinct_hashes) -> int:
    """The fingerprint of a set of shingles, each counted once, as a signed 64-bit number."""
    import numpy as np

    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(distinct_hashes), SLICE):
        ones += np.unpackbits(distinct_hashes[at : at + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(distinct_hashes), bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, width: int = 5) -> DataFrame:
    """(id, fp) of every row; fp is the fingerprint as a long."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            fp = [fingerprint(x, width) for x in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["id", "fp"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def block_shards(entries: DataFrame, radius: int, count: int) -> DataFrame:
    """(shard, fp): entries within the radius share at least one shard. The number of blocks that make up
    a shard follows from the number of entries, so that shards stay small at any size."""
    for same in itertools.count(1):
        blocks = radius + same
        if blocks == BITS or count >> (BITS * same // blocks) <= PER_SHARD:
            break
    edges = [round(BITS * i / blocks) for i in range(blocks + 1)]
    fp = F.col("fp")
    parts = [
        F.shiftrightunsigned(F.shiftleft(fp, BITS - hi), BITS - hi + lo) if hi - lo < BITS else fp
        for lo, hi in zip(edges, edges[1:])
    ]
    keys = [
        F.xxhash64(F.lit(i), *(parts[j] for j in chosen))
        for i, chosen in enumerate(itertools.combinations(range(blocks), same))
    ]
    return entries.select(F.explode(F.array(*keys)).alias("shard"), *entries.columns)


def chunked(sharded: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """Adds (chunk, other, home): pairs of chunks that must meet. A shard of up to `most` entries is chunk 0
    alone. Only shards above that are listed and joined; there are at most entries / `most` of them."""
    hot = (
        sharded.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > most)
        .select("shard", F.ceil(F.col("n") * 2 / most).cast("int").alias("chunks"))
    )
    hot = scratch.save(hot, "hot")  # its size is known from here on: it is broadcast only if it is small
    own = F.pmod(F.xxhash64("fp", "node", F.lit(7)), F.col("chunks")).cast("int")
    meets = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.col("chunks") - 1),
            lambda j: F.struct(F.least(F.col("own"), j).alias("chunk"), F.greatest(F.col("own"), j).alias("other")),
        )
    )
    joined = sharded.join(hot, "shard", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("own", own)
    return joined.withColumn("at", meets).select("*", "at.chunk", "at.other").drop("at", "chunks")


class BKTree:
    """Hamming distances of 64-bit numbers; children are keyed by their distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at, self_at = 0, len(self.values)
        self.values.append(value)
        self.children.append({})
        while self_at:
            d = (self.values[at] ^ value).bit_count()
            below = self.children[at].setdefault(d, self_at)
            if below == self_at:
                return
            at = below

    def near(self, value: int, radius: int) -> list[tuple[int, int]]:
        """(distance, position) of all entries within the radius."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append((d, at))
            todo += [c for e, c in self.children[at].items() if -radius <= e - d <= radius]
        return found


def forest(values: list[int], homes: list[int], radius: int, alike=None) -> tuple[list[tuple[int, int]], set[int]]:
    """Positions of linked pairs, a spanning forest of the links between a tree's entries and the others, and positions with an
    undecided pair. homes: the chunk that an entry is of; the first one's entries make up the tree. alike: a further test of a pair (None:
    undecided), nearest pairs first; its maybe(i, js) gives the places in js of those that can pass."""
    root = list(range(len(values)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    tree, place, links, open_ = BKTree(), [], [], set()
    first = min(homes)
    for i in sorted(range(len(values)), key=lambda i: homes[i]):
        found = tree.near(values[i], radius)
        if alike and found:
            own = top(i)
            found = [(d, at) for d, at in sorted(found) if top(place[at]) != own]
            found = [found[n] for n in alike.maybe(i, [place[at] for _, at in found])]
        for _, at in found:
            j = place[at]
            a, b = top(i), top(j)
            if a == b:
                continue
            verdict = alike is None or alike(i, j)
            if verdict:
                root[max(a, b)] = min(a, b)
                links.append((i, j))
            elif verdict is None:
                open_ |= {i, j}
        if homes[i] == first:
            tree.add(values[i])
            place.append(i)
    return links, open_


def links(sharded: DataFrame, radius: int, scratch: Scratch, alike=None, payload: str | None = None) -> DataFrame:
    """(a, b, shard, fp): links found in all shards, and with null b the entries of a shard with undecided pairs. sharded: shard, fp, node
    (what a and b hold), and a payload; alike: makes a test of pairs from the payloads of a group."""
    mask = (1 << BITS) - 1

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def solve(t):
            if t.num_rows < 2:
                return []
            node, more = t.column("node").to_pylist(), t.column(payload).to_pylist() if payload else None
            values = [x & mask for x in t.column("fp").to_pylist()]
            test = alike(more) if payload else None
            pairs, open_ = forest(values, t.column("own").to_pylist(), radius, test)
            shard, fp = t.column("shard")[0].as_py(), t.column("fp").to_pylist()
            return [(node[i], node[j], shard, None) for i, j in pairs] + [(node[i], None, shard, fp[i]) for i in sorted(open_)]

        def out(pairs):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs)], ["a", "b", "shard", "fp"])

        held = None  # rows of the last group, which may go on in the next batch
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            key = np.stack([t.column(c).to_numpy() for c in ("shard", "chunk", "other")])
            starts = np.r_[0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, t.num_rows]
            pairs = []
            for lo, hi in zip(starts[:-2], starts[1:-1]):
                if hi - lo > 1:
                    pairs += solve(t.slice(lo, hi - lo))
            held = t.slice(starts[-2]).combine_chunks()
            if pairs:
                yield out(pairs)
        if held is not None and (pairs := solve(held)):
            yield out(pairs)

    wanted = ["shard", "chunk", "other", "own", "fp", "node"] + ([payload] if payload else [])
    rows = chunked(sharded, scratch, TREE_OF_SETS if payload else TREE).select(*wanted)
    dealt = rows.repartition("shard", "chunk", "other").sortWithinPartitions("shard", "chunk", "other", "own", "fp", "node")
    return dealt.mapInArrow(run, "a long, b long, shard long, fp long")


def linked(spark: SparkSession, rows: DataFrame, radius: int) -> DataFrame:
    """(id, fp, component_id) for rows (id, fp): the smallest id reachable over links of at most `radius` bits."""
    scratch = Scratch(spark, "simhash")
    rows = scratch.save(rows, "rows")
    entries = scratch.save(rows.groupBy("fp").agg(F.min("id").alias("first")), "entries")
    sharded = block_shards(entries.select("fp"), radius, entries.count()).withColumn("node", F.col("fp"))
    roots = components(scratch.save(links(sharded, radius, scratch).select("a", "b"), "edges"), scratch)
    # Only entries that have a link are joined; the others are a component of their own.
    own = entries.join(roots, entries.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    own = scratch.save(own, "own")
    least = own.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(own.join(least, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, radius: int = 3) -> DataFrame:
    """(id, fingerprint, component_id) of every row; fingerprint as 16 hex digits."""
    found = linked(df.sparkSession, fingerprints(df, id_col, text_col, width), radius)
    return found.select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


class Sets:
    """Sets, each given by its smallest hashes, and whether two have at least a Jaccard similarity."""

    def __init__(self, payload: list[bytes], similarity: float):
        import numpy as np

        self.np, self.similarity, self.sets = np, similarity, [np.frombuffer(x, np.uint32) for x in payload]
        self.size = np.array([len(x) for x in self.sets])
        self.all = np.full((len(payload), BOTTOM), 1 << 40, np.int64)  # no hash is that large
        for row, own in zip(self.all, self.sets):
            row[: len(own)] = own

    def maybe(self, i: int, js: list[int]):
        """Places of those with enough hashes in common; for whole sets that decides."""
        np, own = self.np, self.sets[i].astype(self.np.int64)
        js = np.array(js, np.int64)
        if not len(own) or not len(js):
            return np.flatnonzero(self.size[js] == len(own)).tolist()
        rows = self.all[js]
        common = (own[np.minimum(np.searchsorted(own, rows), len(own) - 1)] == rows).sum(1)
        whole = np.maximum(self.size[js], len(own)) < BOTTOM
        least = np.where(whole, self.similarity * (self.size[js] + len(own) - common), (self.similarity - UNLIKELY) * BOTTOM)
        return np.flatnonzero(common >= least).tolist()

    def __call__(self, i: int, j: int) -> bool | None:
        np, a, b = self.np, self.sets[i], self.sets[j]
        if not len(a) or not len(b):
            return len(a) == len(b)
        both = np.concatenate([a, b])
        both.sort()
        twice = both[1:] == both[:-1]
        if max(len(a), len(b)) < BOTTOM:
            return bool(twice.sum() >= self.similarity * (len(both) - twice.sum()))
        rank = np.r_[True, ~twice].cumsum()[1:]  # of distinct hashes
        share = (twice & (rank <= BOTTOM)).sum() / BOTTOM
        return True if share >= self.similarity + SURE else False if share < self.similarity - UNLIKELY else None


class WholeSets:
    """The same for whole sets of any size, of hashes of so many bytes."""

    def __init__(self, payload: list[bytes], similarity: float, width: int = 4):
        import numpy as np

        self.np, self.similarity, self.sets = np, similarity, [np.frombuffer(x, f"<u{width}") for x in payload]
        self.size = np.array([len(x) for x in self.sets])

    def maybe(self, i: int, js: list[int]):
        """Places of those whose sizes allow it."""
        np, own = self.np, len(self.sets[i])
        size = self.size[np.array(js, np.int64)]
        return np.flatnonzero(np.minimum(size, own) >= self.similarity * np.maximum(size, own)).tolist()

    def __call__(self, i: int, j: int) -> bool:
        if not len(self.sets[i]) or not len(self.sets[j]):
            return len(self.sets[i]) == len(self.sets[j])
        common = len(self.np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
        return bool(common >= self.similarity * (len(self.sets[i]) + len(self.sets[j]) - common))


def _bitmap(nodes: DataFrame) -> bytes:
    """Bits of all nodes, by their remainder. 2^27 bits (16 MB) at most: for more nodes it lets through more, never fewer."""
    bits = 1 << min(27, max(16, (16 * nodes.count()).bit_length()))
    words = nodes.select(F.pmod("node", F.lit(bits)).alias("at")).groupBy(F.shiftright("at", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 as int))")).alias("v")).toArrow()
    import numpy as np

    out = np.zeros(bits // 32, np.uint32)
    out[words["w"].to_numpy()] = words["v"].to_numpy().astype(np.uint32)
    return out.tobytes()


def distinct(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, exact: bool = False) -> DataFrame:
    """The rows of `df` without near copies: of each group of texts that links of `similarity` or more connect, the row with the
    smallest id stays (null ids last; of repeated rows one). Texts without words are alike."""
    spark, scratch = df.sparkSession, Scratch(df.sparkSession, "distinct")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.xxhash64(text)

    def describe(batches):
        import numpy as np
        import pyarrow as pa

        turns = np.arange(1, ANCHORS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
        for b in batches:
            fps, anchors, sets = [], [], []
            for x in b.column(2).cast(pa.binary()).to_pylist():
                h = np.unique(np.concatenate([np.empty(0, np.uint64), *shingle_hashes(x, width)]))
                fps.append(set_fingerprint(h))
                if exact:  # sets that are similar enough have one of their first hashes in common
                    anchors.append(h[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1].view(np.int64).tolist() if len(h) else [0])
                    sets.append(h.tobytes())
                else:
                    anchors.append([int((h * t).min().view(np.int64)) for t in turns] if len(h) else [0] * ANCHORS)
                    sets.append(np.unique((h >> np.uint64(32)).astype(np.uint32))[:BOTTOM].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fps, pa.int64()), pa.array(anchors, pa.list_(pa.int64())), pa.array(sets, pa.binary())],
                ["id", "node", "fp", "anchors", "bottom"],
            )

    rows = df.select(F.col(id_col).cast("long").alias("id"), key.alias("node"), text.alias("text"))
    rows = scratch.save(rows.mapInArrow(describe, "id long, node long, fp long, anchors array<long>, bottom binary"), "rows")
    texts = rows.groupBy("node").agg(F.first("fp").alias("fp"), F.first("anchors").alias("anchors"), F.first("bottom").alias("bottom"))
    sharded = texts.select("node", "fp", "bottom", F.posexplode("anchors").alias("i", "anchor"))
    sharded = sharded.select(F.xxhash64(F.lit(0) if exact else "i", "anchor").alias("shard"), "node", "fp", "bottom")
    test = (lambda sets: WholeSets(sets, similarity, 8)) if exact else (lambda sets: Sets(sets, similarity))
    found = scratch.save(links(sharded, BITS if exact else WIDE, scratch, test, "bottom"), "found")
    edges, undecided = found.where("b is not null").select("a", "b"), found.where("b is null").select("shard", "fp", F.col("a").alias("node")).distinct()
    if undecided.limit(1).count():

        marked = _bitmap(undecided.select("node"))
        sent = spark.sparkContext.broadcast(marked)

        def whole(batches):
            import numpy as np
            import pyarrow as pa

            for b in batches:
                node = b.column(0).to_numpy()
                at = node.view(np.uint64) % np.uint64(8 * len(sent.value))
                bits = np.frombuffer(sent.value, np.uint8)[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
                own = np.flatnonzero(bits)
                texts = b.column(1).take(pa.array(own)).cast(pa.binary()).to_pylist()
                sets = [np.unique(np.concatenate([np.empty(0, np.uint32), *((h >> np.uint64(32)).astype(np.uint32) for h in shingle_hashes(x, width))])).tobytes() for x in texts]
                yield pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(sets, pa.binary())], ["node", "whole"])

        # Most texts are left out by the bitmap where they are read; what it lets through by chance goes in the join.
        those = df.select(key.alias("node"), text.alias("text")).mapInArrow(whole, "node long, whole binary")
        those = those.groupBy("node").agg(F.first("whole").alias("whole"))
        again = links(undecided.join(those, "node"), WIDE, scratch, lambda sets: WholeSets(sets, similarity), "whole")
        edges = edges.unionByName(again.select("a", "b"))
    roots = components(scratch.save(edges, "edges"), scratch)
    every = rows.groupBy("id", "node").agg(F.count("*").alias("n"))
    every = every.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "node", "n")).alias("m")
    kept = scratch.save(every.groupBy("root").agg(least).select("m.id", "m.node", "m.n"), "kept")
    marked = df.withColumn("_node", key)
    own = lambda k: (marked["_node"] == k["node"]) & marked[id_col].cast("long").eqNullSafe(k["id"])
    once = kept.where("n = 1")
    single = marked.join(once, own(once), "left_semi")
    more = kept.where("n > 1")
    if more.limit(1).count():  # repeated rows: any of them
        single = single.unionByName(marked.join(more, own(more), "left_semi").dropDuplicates(["_node", id_col]))
    return single.drop("_node")
