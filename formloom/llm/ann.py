"""Nearest neighbours by inner product: inverted lists, scanned a block of dimensions at a time.

Vectors, divided by the largest length, get one more component, sqrt(1 - |x|^2) (0 for queries): the squared distance to a
query is then a constant less twice the inner product. All are turned by one random rotation, after which any leading
columns of a difference estimate its whole length. Vectors lie in lists by their nearest centroid; a query visits the lists of
its nearest centroids. Within a list, candidates are scanned in column blocks. After each block a test abandons the
candidates whose distance so far, scaled up, exceeds (1 + EPSILON / sqrt(columns seen)) times the distance of the query's
20th best so far. What is left is scored exactly, in double precision on the vectors as given.

The index (rotation, centroids, number of lists visited) is fitted on `sample` rows of smallest hash, and has a list for sixteen of them at
most; all rows are indexed. As many lists are visited as find `recall` of the sample queries' neighbours within the sample, and further
ones where these hold fewer than k candidates. With exact=True all lists are visited and nothing is abandoned.

Work is dealt in shelves: whole lists of ROWS rows together, or parts of longer lists, and in blocks of about QUERIES queries. Blocks follow a
tour of the lists, so that a block's queries lie near each other and visit few shelves; a task scans one shelf for one block, and only pairs of a
shelf and a block that visits it are made. Its memory is bounded for lists of any length.

Vectors of doubles are scored as doubles. Rows take no part if their id or vector is null, or the vector is zero, has a null or non-finite
component, or not the length that most vectors have. Rows with the query's id are its own and no candidates of it. Repeated candidates are candidates each;
repeated queries are one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Scratch

SAMPLE, SAMPLE_QUERIES, RECALL = 1 << 14, 256, 0.975
ROWS, QUERIES = 4096, 4096
BLOCK, EPSILON, STRIP = 16, 2.1, 512
FEWEST, ROWS_A_LIST = 8, 16


class Index:
    """Rotation, centroids and the number of lists to visit."""

    def __init__(self, sample, largest: float, rows: int, k: int, recall: float = RECALL, seed: int = 17):
        import numpy as np

        rng = np.random.RandomState(seed)
        self.largest, dims = largest, sample.shape[1] + 1
        self.rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0].astype(np.float32)
        x = self.place(sample)
        lists = min(max(1, len(x)), max(FEWEST, min(len(x) // ROWS_A_LIST, 1 << max(0, round(np.log2(max(1.0, rows**0.5 / 2)))))))
        self.centroids = x[rng.choice(len(x), lists, replace=False)]
        for _ in range(8):
            own = self.nearest(x, 1)[:, 0]
            sums, n = np.zeros((lists, dims)), np.bincount(own, minlength=lists)
            np.add.at(sums, own, x)
            self.centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], self.centroids).astype(np.float32)
        own = self.nearest(x, 1)[:, 0]
        q = rng.choice(len(x), min(len(x), SAMPLE_QUERIES), replace=False)
        score = sample[q].astype(np.float64) @ sample.T.astype(np.float64)
        score[np.arange(len(q)), q] = -np.inf
        k = min(k, len(x) - 1)
        self.probes = lists
        if k > 0:
            best = np.argpartition(-score, k - 1, axis=1)[:, :k]
            order = self.nearest(self.place(sample[q], query=True), lists)
            rank = np.take_along_axis(np.argsort(order, axis=1), own[best], axis=1)
            found = np.bincount(rank.ravel(), minlength=lists).cumsum() / rank.size
            self.probes = int(np.argmax(found >= recall)) + 1 if recall < 1 else lists

    def place(self, x, query: bool = False):
        import numpy as np

        x = np.asarray(x, np.float64) / self.largest
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, 1 - (x * x).sum(1)))
        return np.c_[x, last].astype(np.float32) @ self.rotation

    def nearest(self, placed, n: int):
        """Lists by distance of their centroids, nearest first."""
        import numpy as np

        far = (self.centroids**2).sum(1) / 2 - placed @ self.centroids.T
        return far.argmin(1)[:, None] if n == 1 else np.argsort(far, axis=1, kind="stable")[:, :n]

    def tour(self):
        """The lists in an order in which each is followed by the nearest one that is left."""
        import numpy as np

        left, at, out = np.ones(len(self.centroids), bool), 0, []
        for _ in range(len(self.centroids)):
            out.append(at)
            left[at] = False
            far = ((self.centroids - self.centroids[at]) ** 2).sum(1)
            at = int(np.where(left, far, np.inf).argmin())
        return out


class Scan:
    """The best candidates so far of a group of queries."""

    def __init__(self, index: Index, q, q_ids, x, x_ids, k: int, epsilon: float = EPSILON):
        import numpy as np

        self.q64, self.x64, self.q_ids, self.x_ids, self.k = q.astype(np.float64), x.astype(np.float64), q_ids, x_ids, k
        self.qp, self.xp = index.place(q, query=True), index.place(x)
        self.dims, self.scale, self.epsilon = self.qp.shape[1], 1 / index.largest, epsilon
        self.base = ((self.q64 * self.scale) ** 2).sum(1) + 1
        self.top_s, self.top_i = np.full((len(q), k), -np.inf), np.full((len(q), k), -1, np.int64)
        edges = [*range(0, self.dims, BLOCK), self.dims]
        self.blocks = list(zip(edges, edges[1:]))
        squares = lambda m: np.stack([(m[:, lo:hi] ** 2).sum(1) for lo, hi in self.blocks])
        self.q2, self.x2 = squares(self.qp), squares(self.xp)

    def visit(self, ask, have) -> None:
        """Scans the candidates `have`, a list, for the queries `ask`."""
        at, step = 0, 4 * self.k
        while at < len(have):
            self._strip(ask, have[at : at + step])
            at, step = at + step, STRIP

    def _strip(self, ask, have) -> None:
        import numpy as np

        limit = np.maximum(self.base[ask] - 2 * (self.top_s[ask, -1] * self.scale) * self.scale, 0)  # squared distance of the k-th best; infinite before there are k
        part = np.zeros((len(ask), len(have)), np.float32)
        pairs, keep = None, self.q_ids[ask][:, None] != self.x_ids[have][None]
        for b, (lo, hi) in enumerate(self.blocks):
            slack = 1 + (self.epsilon / hi**0.5 if hi < self.dims or not np.isfinite(self.epsilon) else 1e-3)
            test = (limit * slack**2 * (hi / self.dims)).astype(np.float32) if np.isfinite(slack) else np.full(len(ask), np.inf, np.float32)
            if pairs is None:  # while many candidates are left, whole blocks
                part += self.q2[b][ask][:, None] + self.x2[b][have][None]
                part -= 2 * (self.qp[ask, lo:hi] @ self.xp[have, lo:hi].T)
                keep &= part <= test[:, None]
                if np.count_nonzero(keep) * 16 < keep.size:
                    pairs = np.nonzero(keep)
                    part = part[pairs]
            else:
                diff = self.qp[ask[pairs[0]], lo:hi] - self.xp[have[pairs[1]], lo:hi]
                part = part + np.einsum("ij,ij->i", diff, diff)
                stay = part <= test[pairs[0]]
                pairs, part = (pairs[0][stay], pairs[1][stay]), part[stay]
        qi, xi = np.nonzero(keep) if pairs is None else pairs
        if not len(qi):
            return
        qi, xi, score = ask[qi], have[xi], np.empty(len(qi))
        for lo in range(0, len(qi), 1 << 16):  # the same sum for equal vectors
            s = slice(lo, lo + (1 << 16))
            score[s] = (self.q64[qi[s]] * self.x64[xi[s]]).sum(1)
        better = score >= self.top_s[qi, -1]
        qi, xi, score = qi[better], xi[better], score[better]
        # merge with the best so far: larger scores first, ties to smaller ids
        own = np.unique(qi)
        old_q, old_c = np.nonzero(self.top_i[own] >= 0)
        old_q = own[old_q]
        all_q, all_i, all_s = np.r_[old_q, qi], np.r_[self.top_i[old_q, old_c], xi], np.r_[self.top_s[old_q, old_c], score]
        order = np.lexsort((self.x_ids[all_i], -all_s, all_q))
        all_q, all_i, all_s = all_q[order], all_i[order], all_s[order]
        rank = np.arange(len(all_q)) - np.searchsorted(all_q, all_q)
        first = rank < self.k
        self.top_s[all_q[first], rank[first]], self.top_i[all_q[first], rank[first]] = all_s[first], all_i[first]

    def best(self):
        """(query row, candidate row, score)."""
        import numpy as np

        rows, cols = np.nonzero(self.top_i >= 0)
        return rows, self.top_i[rows, cols], self.top_s[rows, cols]


def _vectors(column):
    import numpy as np

    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    own = dict(df.select(vector_col).dtypes)[vector_col]
    v = F.col(vector_col).cast("array<float>" if own == "array<float>" else "array<double>")
    sane = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & sane)
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (most.n if most else 0))


def search(
    df: DataFrame, id_col: str, vector_col: str, is_query, k: int = 20, sample: int = SAMPLE, recall: float = RECALL, epsilon: float = EPSILON, exact: bool = False,
) -> DataFrame:
    """(query_id, rank, id, score): the k nearest of each row for which the column `is_query` (of id) holds."""
    import numpy as np

    spark, out = df.sparkSession, f"query_id long, rank int, {id_col} long, score double"
    scratch = Scratch(spark, "ann")
    rows = usable(df, id_col, vector_col)
    kind = dict(rows.dtypes)["v"]
    recall, epsilon = (1.0, float("inf")) if exact else (recall, epsilon)
    top = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))  # so that squares stay in range
    length = top * F.sqrt(F.aggregate(F.transform("v", lambda x: x.cast("double") / top), F.lit(0.0), lambda s, x: s + x * x))
    facts = rows.agg(F.count("*").alias("n"), F.max(length).alias("largest")).first()
    if not facts.n:
        return spark.createDataFrame([], out)
    chosen = rows.orderBy(F.xxhash64("id", "v"), "id").limit(sample).select("v").collect()
    index = Index(np.array([r.v for r in chosen], np.float64), facts.largest, facts.n, k, recall)
    sent = spark.sparkContext.broadcast(index)

    def listed(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                own = sent.value.nearest(sent.value.place(_vectors(b.column(1))), 1)[:, 0]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.astype(np.int32))], ["id", "v", "list"])

    stored = scratch.save(rows.mapInArrow(listed, f"id long, v {kind}, list int"), "stored")
    sizes = dict(stored.groupBy("list").count().collect())  # a row a list: as many as the sample allows
    counts = np.array([sizes.get(i, 0) for i in range(len(index.centroids))])
    alike = stored.groupBy("id").count().agg(F.max("count")).first()[0]  # rows of one id

    def visiting(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                near = sent.value.nearest(sent.value.place(_vectors(b.column(1)), query=True), len(counts))
                enough = (np.cumsum(counts[near], axis=1) < k + alike).sum(1) + 1
                lists = [own[: max(n, sent.value.probes)].tolist() for own, n in zip(near, enough)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lists, pa.list_(pa.int32()))], ["id", "v", "lists"])

    first, parts, shelf, room = {}, {}, -1, 0
    for own, n in sorted(sizes.items()):
        parts[own] = -(-n // ROWS)
        if n > room or parts[own] > 1:
            shelf, room = shelf + 1, ROWS
        first[own], room = shelf, room - n
        if parts[own] > 1:
            shelf, room = shelf + parts[own] - 1, 0
    where = F.broadcast(spark.createDataFrame([(own, first[own], parts[own]) for own in sizes], "list int, first int, parts int"))
    queries = scratch.save(rows.where(is_query(F.col("id"))).distinct().mapInArrow(visiting, f"id long, v {kind}, lists array<int>"), "queries")
    asking = dict(queries.groupBy(F.col("lists")[0]).count().collect())
    blocks, block, room = [], -1, 0
    for own in index.tour():  # of each list: its first block, and how many it has
        n = asking.get(own, 0)
        if n > room:
            block, room = block + 1, QUERIES
        blocks.append((own, block, max(1, -(-n // QUERIES))))
        room -= n
        if blocks[-1][2] > 1:
            block, room = block + blocks[-1][2] - 1, 0
    blocks = F.broadcast(spark.createDataFrame(blocks, "nearest int, block int, many int"))
    placed = stored.join(where, "list").withColumn("shelf", F.col("first") + F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int")).select("id", "v", "list", "shelf")
    asked = queries.withColumn("nearest", F.col("lists")[0]).join(blocks, "nearest")
    asked = asked.select("id", "v", (F.col("block") + F.pmod(F.xxhash64("id", "v"), F.col("many")).cast("int")).alias("block"), F.explode("lists").alias("list")).join(where, "list")
    asked = asked.select("id", "v", "block", "list", F.explode(F.expr("sequence(first, first + parts - 1)")).alias("shelf"))
    asked = asked.groupBy("id", "v", "block", "shelf").agg(F.collect_list("list").alias("lists"))
    pairs = scratch.save(asked.select("shelf", "block").distinct(), "pairs")
    placed = placed.join(pairs, "shelf")

    def near(left, right):
        import pyarrow as pa

        types = [("query_id", pa.int64()), ("key", pa.int64()), ("id", pa.int64()), ("score", pa.float64())]
        if not (left.num_rows and right.num_rows):
            return pa.table({n: pa.array([], t) for n, t in types})
        x_ids, own, q_ids = left["id"].to_numpy(), left["list"].to_numpy(), right["id"].to_numpy()
        lists = right["lists"].combine_chunks()
        visits = np.zeros((right.num_rows, len(sent.value.centroids)), bool)
        visits[np.repeat(np.arange(right.num_rows), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = True
        scan = Scan(sent.value, _vectors(right["v"]), q_ids, _vectors(left["v"]), x_ids, k, epsilon)
        for each in np.unique(own):
            if len(ask := np.flatnonzero(visits[:, each])):
                scan.visit(ask, np.flatnonzero(own == each))
        a, b, s = scan.best()
        key = right["key"].to_numpy()[a]
        return pa.table({n: pa.array(y, t) for (n, t), y in zip(types, (q_ids[a], key, x_ids[b], s))})

    asked = asked.withColumn("key", F.xxhash64("v"))
    found = placed.groupBy("shelf", "block").cogroup(asked.groupBy("shelf", "block")).applyInArrow(near, "query_id long, key long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
