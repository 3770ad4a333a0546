"""Exact top-k inner products: queries and data in cover trees that are searched together."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import written
from tessera.llm.vector_codes import matrix, scaled, usable

#: Points up to which a node is not divided, by what a level's radius is less than the one above, and a score below all others.
LEAF, BASE = 64, 1.3
NONE = -(1 << 62)
#: Integers up to here are exact as doubles.
EXACT = 1 << 53


class CoverTree:
    """Points in nested balls.

    A node's points lie within ``radius`` of its centre. Its children's centres are more than radius / BASE apart, are among
    its points and cover them within that; the node's centre is the first. A node whose children would hold fewer
    than four points each on average, as in many dimensions without clusters, stays undivided. Nodes are numbered level by level;
    ``first`` and ``last`` are the range of a node's children, ``start`` and ``end`` that of its points in ``order``.
    """

    def __init__(self, points: np.ndarray) -> None:
        self.order = np.arange(len(points))
        squares = (points * points).sum(axis=1)
        start, end, centre, radius, first, last = [0], [len(points)], [0], [], [], []
        at = 0
        while at < len(start):
            s, e = start[at], end[at]
            own = self.order[s:e]
            far = np.sqrt(np.maximum(0, squares[own] + squares[centre[at]] - 2 * (points[own] @ points[centre[at]])))
            radius.append(float(far.max()))
            first.append(len(start))
            if e - s > LEAF and radius[-1] > 0 and (kids := self._cover(points, squares, own, far, centre[at], radius[-1] / BASE)):
                ends = s + np.cumsum([len(k) for _, k in kids])
                self.order[s:e] = np.concatenate([k for _, k in kids])
                start += [s, *ends[:-1].tolist()]
                end += ends.tolist()
                centre += [c for c, _ in kids]
            last.append(len(start))
            at += 1
        self.start, self.end, self.first, self.last = (np.array(x) for x in (start, end, first, last))
        self.centre = points[np.array(centre)]
        self.length = np.sqrt((self.centre * self.centre).sum(axis=1))
        self.radius = np.array(radius) * (1 + 1e-9)

    @staticmethod
    def _cover(points: np.ndarray, squares: np.ndarray, own: np.ndarray, far: np.ndarray, centre: int, r: float) -> list[tuple[int, np.ndarray]]:
        kids, rest = [(centre, own[far <= r])], own[far > r]
        while len(rest):
            if 4 * len(kids) >= len(own):
                return []
            c = int(rest[0])
            near = squares[rest] + squares[c] - 2 * (points[rest] @ points[c]) <= r * r
            near[0] = True
            kids.append((c, rest[near]))
            rest = rest[~near]
        return kids


def upper_bound(a_centre: np.ndarray, a_length: np.ndarray, a_radius: np.ndarray, b_centre: np.ndarray, b_length: np.ndarray, b_radius: np.ndarray) -> np.ndarray:
    """What no inner product of a point of ball a with one of ball b exceeds, pair by pair."""
    middle = np.einsum("ij,ij->i", a_centre, b_centre)
    bound = np.minimum(middle + a_radius * b_length + b_radius * a_length + a_radius * b_radius, (a_length + a_radius) * (b_length + b_radius))
    return bound + 1e-9 * np.abs(bound) + 1e-3


@dataclass
class Points:
    """Rows with their ids and vectors; an id may be null (``blank``)."""

    row: np.ndarray
    ids: np.ndarray
    blank: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, batches: list[pa.RecordBatch], kind: str) -> Points:
        table = pa.Table.from_batches(batches).combine_chunks()
        vectors = np.frombuffer(b"".join(table["v"].to_pylist()), kind).reshape(table.num_rows, -1)
        blank = table["vec_id"].is_null().to_numpy()
        return cls(table["row"].to_numpy(), table["vec_id"].fill_null(0).to_numpy(), blank, vectors.astype(float))


@dataclass
class Best:
    """The k best hits of each query so far: score down, then known id up."""

    queries: Points
    kth: np.ndarray
    k: int
    score: np.ndarray = field(init=False)
    ids: np.ndarray = field(init=False)
    blank: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        shape = (len(self.kth), self.k)
        self.score, self.ids, self.blank = np.full(shape, NONE), np.zeros(shape, np.int64), np.zeros(shape, bool)

    def offer(self, queries: np.ndarray, score: np.ndarray, data: Points, own: np.ndarray) -> None:
        """Scores (queries, own) of the data rows ``own``."""
        score = np.where(self.queries.row[queries][:, None] == data.row[own], NONE, score)
        least = self.kth[queries]
        if len(own) > self.k:
            least = np.maximum(least, np.partition(score, -self.k, axis=1)[:, -self.k])
        q, d = np.nonzero((score >= least[:, None]) & (score != NONE))
        if not len(q):
            return
        touched, back = np.unique(q, return_inverse=True)
        of = queries[touched]
        who = np.concatenate([np.repeat(np.arange(len(of)), self.k), back])
        scores = np.concatenate([self.score[of].ravel(), score[q, d]])
        ids = np.concatenate([self.ids[of].ravel(), data.ids[own[d]]])
        blank = np.concatenate([self.blank[of].ravel(), data.blank[own[d]]])
        order = np.lexsort((ids, blank, -scores, who))
        starts = np.searchsorted(who[order], np.arange(len(of)))
        pick = order[(starts[:, None] + np.arange(self.k)).ravel()]
        self.score[of], self.ids[of], self.blank[of] = (x[pick].reshape(-1, self.k) for x in (scores, ids, blank))
        self.kth[of] = np.maximum(self.kth[of], self.score[of, -1])


def dual_search(queries: CoverTree, best: Best, tree: CoverTree, data: Points, exact: bool) -> None:
    """Offers ``best`` all pairs of points but those of node pairs whose bound is below the worst kth score of the queries' node."""
    kth = best.kth[queries.order]
    worst = np.array([kth[s:e].min() for s, e in zip(queries.start.tolist(), queries.end.tolist(), strict=True)], float)
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    leaves: list[tuple[np.ndarray, ...]] = []
    while len(a):
        bound = upper_bound(queries.centre[a], queries.length[a], queries.radius[a], tree.centre[b], tree.length[b], tree.radius[b])
        a, b, bound = (x[bound >= worst[a]] for x in (a, b, bound))
        a_kids, b_kids = queries.last[a] - queries.first[a], tree.last[b] - tree.first[b]
        whole = (a_kids == 0) & (b_kids == 0)
        leaves.append((a[whole], b[whole], bound[whole]))
        split_a = ~whole & ((b_kids == 0) | ((a_kids > 0) & (queries.radius[a] >= tree.radius[b])))
        split_b = ~whole & ~split_a
        down = lambda first, n: np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())  # noqa: E731  all children of some nodes
        a, b = (
            np.concatenate([down(queries.first[a[split_a]], a_kids[split_a]), np.repeat(a[split_b], b_kids[split_b])]),
            np.concatenate([np.repeat(b[split_a], a_kids[split_a]), down(tree.first[b[split_b]], b_kids[split_b])]),
        )
    a, b, bound = (np.concatenate(x) for x in zip(*leaves, strict=True))
    kind = float if exact else np.int64
    for i in np.argsort(-bound, kind="stable").tolist():
        of = queries.order[queries.start[a[i]] : queries.end[a[i]]]
        of = of[best.kth[of] <= bound[i]]
        if len(of):
            own = tree.order[tree.start[b[i]] : tree.end[b[i]]]
            best.offer(of, (best.queries.vectors[of].astype(kind) @ data.vectors[own].astype(kind).T).astype(np.int64), data, own)


def _meet(rows: DataFrame, kind: str, k: int, exact: bool) -> DataFrame:
    """The k best hits of each query within each chunk that it is dealt to.

    ``rows`` holds data (``role`` 0) and queries (1) of each chunk; a task reads a chunk's data, then its queries by block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, trees, data, group, asked = None, None, [], None, []

        def answered() -> Iterator[pa.RecordBatch]:
            nonlocal trees, asked
            if not asked or not data:
                asked = []
                return
            if trees is None:
                table = pa.Table.from_batches(data)
                trees = []
                for node in np.unique(table["node"].to_numpy()).tolist():
                    points = Points.of(table.filter(pc.equal(table["node"], node)).to_batches(), kind)
                    trees.append((CoverTree(points.vectors), points))
            queries = Points.of(asked, kind)
            kth = np.concatenate([b.column("kth").fill_null(NONE).to_numpy() for b in asked])
            best, own = Best(queries, kth, k), CoverTree(queries.vectors)
            for tree, points in sorted(trees, key=lambda t: -float(t[0].centre[0] @ own.centre[0])):
                dual_search(own, best, tree, points, exact)
            q, at = np.nonzero(best.score != NONE)
            asked = []
            if len(q):
                hits = pa.array(best.ids[q, at], mask=best.blank[q, at])
                yield pa.RecordBatch.from_arrays([pa.array(queries.row[q]), pa.array(queries.ids[q]), hits, pa.array(best.score[q, at])], names=["row", "query_id", "vec_id", "score"])

        for batch in batches:
            keys = list(zip(batch.column("chunk").to_pylist(), batch.column("role").to_pylist(), batch.column("block").to_pylist(), strict=True))
            at = 0
            while at < len(keys):
                upto = at
                while upto < len(keys) and keys[upto] == keys[at]:
                    upto += 1
                part, (c, role, block) = batch.slice(at, upto - at), keys[at]
                if (c, role, block) != (chunk, 1, group):
                    yield from answered()
                if c != chunk:
                    chunk, trees, data = c, None, []
                group = block
                (asked if role else data).append(part)
                at = upto
        yield from answered()

    dealt = rows.repartition("chunk").sortWithinPartitions("chunk", "role", "block")
    return dealt.mapInArrow(run, "row long, query_id long, vec_id long, score long")


def top_k(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    every: int = 50,
    k: int = 5,
    scale: int = 256,
    nodes: int = 64,
    sample: int = 4096,
    chunk_rows: int = 65_536,
    chunks: int = 16,
    block_rows: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k other rows of greatest inner product for each query, a row whose id ``every`` divides.

    Components are multiplied by ``scale`` and rounded down; scores are exact integers. Ties go to the smaller id.

    A cover tree of ``sample`` rows, chosen by a hash, gives ``nodes`` centres; every row, query or not, belongs to its nearest one, and each
    node's covering radius is taken over all its rows. Nodes are dealt into ``chunks`` chunks or more, of ``chunk_rows`` rows at most on average, a
    large node into several by a hash of the row. Queries first meet their own chunk, which gives each a kth score; then those chunks that hold a node whose
    bound reaches the worst kth score of the queries' node. Within a chunk the trees of a query block and of each node's rows are
    searched together in the same manner. Nothing is left out that could be a hit; bounds only save work.

    Rows whose vector is null or holds null or non-finite components take no part. Shorter vectors count as padded by zeros. Every
    row but the query's own is a candidate, so a row that repeats its id and vector is a hit of the other. Null ids are no queries and
    come last among ties. Scores that a long can't hold are an error. Other columns are ignored. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    vec = F.col(vec_col)
    kept = vectors.filter(usable(vec)).select(F.col(id_col).cast("long").alias("vec_id"), scaled(vec, scale).alias("v"))
    facts = kept.agg(F.max(F.size("v")).alias("size"), F.max(F.array_max(F.transform("v", F.abs))).alias("top"), F.count(F.lit(1)).alias("n")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    size, top = max(1, facts["size"]), facts["top"] or 0
    if size * top * top >= 1 << 62:
        raise ValueError("components are too large for scores that fit a long")
    exact = size * top * top < EXACT
    kind = next(f"<i{w}" for w in (2, 4, 8) if top < 1 << 8 * w - 1)
    kept = kept.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("v")))).withColumn("row", F.monotonically_increasing_id())

    picked = kept.select("v", F.xxhash64("row").alias("at"), "row").orderBy("at", "row").limit(sample).select("v").collect()
    tree = CoverTree(np.array([r["v"] for r in picked], float))
    opened = [0]
    while grown := [n for n in opened if tree.last[n] > tree.first[n]]:
        widest = max(grown, key=lambda n: tree.radius[n])
        if len(opened) - 1 + tree.last[widest] - tree.first[widest] > nodes:
            break
        opened = [n for n in opened if n != widest] + list(range(tree.first[widest], tree.last[widest]))
    centres = tree.centre[opened] if len(opened) > 1 else np.array([r["v"] for r in picked[:nodes]], float)
    lengths = np.sqrt((centres * centres).sum(axis=1))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1))
                squares = (x.astype(float) ** 2).sum(axis=1)
                far = squares[:, None] + lengths**2 - 2 * (x.astype(float) @ centres.T)
                node = far.argmin(axis=1)
                packed = [v.tobytes() for v in x.astype(kind)]
                distance = np.sqrt(np.maximum(0, far[np.arange(len(x)), node])) * (1 + 1e-6) + 1e-6
                yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array(packed, pa.binary()), pa.array(node.astype(np.int32)), pa.array(distance)], names=["row", "vec_id", "v", "node", "far"])

    rows = written(kept.select("vec_id", "v", "row").mapInArrow(placed, "row long, vec_id long, v binary, node int, far double"), "placed")
    query = F.col("vec_id").isNotNull() & (F.col("vec_id") % every == 0)
    zero = np.zeros(len(centres))
    count, far, asks, ask_far = (zero.copy() for _ in range(4))
    for r in rows.groupBy("node", query.alias("query")).agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect():
        count[r["node"]] += r["n"]
        far[r["node"]] = max(far[r["node"]], r["far"])
        if r["query"]:
            asks[r["node"]], ask_far[r["node"]] = r["n"], r["far"]

    # chunks: a node too large for one has several of its own, small ones share
    target = min(chunk_rows, -(-facts["n"] // chunks))
    low, shares, at, full = [], [], 0, 0.0
    for n in count.tolist():
        own = max(1, -(-int(n) // target))
        if full and (own > 1 or full + n > target):
            at, full = at + 1, 0.0
        low.append(at)
        shares.append(own)
        at, full = (at + own, 0.0) if own > 1 else (at, full + n)
    of_node = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("node") + 1)
    chunk = of_node(low) + F.pmod(F.xxhash64("row"), of_node(shares)).cast("int")
    data = rows.select(chunk.alias("chunk"), F.lit(0).alias("role"), F.lit(0).alias("block"), "node", "row", "vec_id", "v", F.lit(None).cast("long").alias("kth"))
    block = F.col("node") * 65_536 + F.pmod(F.xxhash64("row", F.lit(1)), of_node(np.maximum(1, -(-asks // block_rows)))).cast("int")
    queries = rows.filter(query).select(chunk.alias("chunk"), F.lit(1).alias("role"), block.alias("block"), "node", "row", "vec_id", "v")

    home = written(_meet(data.unionByName(queries.withColumn("kth", F.lit(None).cast("long"))), kind, k, exact), "home_hits")
    kth = home.groupBy("row").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("kth"))
    known = written(queries.join(kth, "row", "left"), "queries")
    worst = np.full(len(centres), -np.inf)
    for r in known.groupBy("node").agg(F.min(F.coalesce("kth", F.lit(int(NONE)))).alias("kth")).collect():
        worst[r["node"]] = r["kth"]
    pairs = []
    for n in np.flatnonzero(asks).tolist():
        m = len(centres)
        bound = upper_bound(np.repeat(centres[[n]], m, axis=0), np.full(m, lengths[n]), np.full(m, ask_far[n]), centres, lengths, far)
        pairs += [(n, a, b) for a, b in {(low[j], low[j] + shares[j] - 1) for j in np.flatnonzero((bound >= worst[n]) & (count > 0)).tolist()}]
    visits = spark.createDataFrame(pairs or [(-1, 0, 0)], "node int, low int, high int")
    rest = known.withColumnRenamed("chunk", "home").join(F.broadcast(visits), "node").withColumn("chunk", F.explode(F.sequence("low", "high"))).filter(F.col("chunk") != F.col("home"))
    hits = home.unionByName(_meet(data.unionByName(rest.select(data.columns)), kind, k, exact))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
