"""Exact top-k inner-product search by dual-tree search over cover trees.

Vectors go to the nearest of at most `PIVOTS` pivots, which are spread over a bounded
sample (farthest first); a pivot's vectors are a cell, a large cell is several blocks.
A cell has its pivot as centre and a covering radius, so no vector of it scores more
with a query q than q . c + |q| R. Queries first meet the cell of the largest q . c,
which gives each a kth score to beat; then only the cells whose bound reaches it.

Where a block of points meets the queries that come to it, each side gets a cover
tree. A node has a centre (one of its points), a covering radius and children; the
children's covering radius is smaller by `BASE`, and their centres lie further apart
than it. What is left of a node where such children would hold next to nothing, as in
many dimensions without clusters, stays one leaf, however large, and meets queries in
matrix products. A pair of nodes is searched depth first, best bound first, and left out if
no query below the one can gain from any point below the other: the inner product of
any two of their points is at most
(q + dq) . (r + dr) <= q.r + |r| Rq + |q| Rr + Rq Rr, and the group of queries has a
worst kth score, which starts from the scores that the queries bring along.

Scores are whole numbers, computed as floats or doubles where these hold them exactly and else as
64-bit integers (beyond 2^63 they wrap), so ties are exact and go to the smaller id.
Pivots, radii and counts are all that the driver sees: at most `PIVOTS` rows, and one
for each length of vector that the sample lacks.

Defined cases: vectors that are null, hold a null or non-finite component, or have
no id or no component take no part; one of another length than a query has no score
with it. A repeated id is a candidate for each of its rows, and its queries are one
query for each distinct vector; its own rows are no candidates. Fewer than k
candidates: all of them. An empty table gives an empty table. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampliscope.llm.common import materialize, ship

SCALE = 256
K, EVERY = 5, 50
#: Rows of a block of points, and of queries that meet it in one task, about.
POINTS, QUERIES = 8192, 2048
#: Pivots at most, points for each of them at least, about, and the vectors that they are chosen from.
PIVOTS, EACH, SAMPLE = 1024, 2048, 16_384
#: A node of so many points or fewer isn't split.
LEAF = 64
#: A child of fewer points doesn't pay for its visits; after so many of them it is tried whether others would.
FEW, TRIES = 16, 16
#: Leaves that a leaf of queries meets at a time, and queries.
TOGETHER, ABREAST = 16, 1024
#: By how much the covering radius shrinks from a node to its children.
BASE = 1.3


@dataclass
class Node:
    centre: int
    radius: float
    points: np.ndarray
    children: list[Node] = field(default_factory=list)
    #: Of the children: vectors and norms of the centres, radii, and whether they have children.
    vectors: np.ndarray | None = None
    norms: np.ndarray | None = None
    radii: np.ndarray | None = None
    split: np.ndarray | None = None
    #: The worst kth score of the queries below, as far as it is known.
    worst: float = -np.inf


class CoverTree:
    def __init__(self, vectors: np.ndarray):
        self.whole = vectors.astype(np.int64)
        self.vectors = vectors.astype(np.float64)
        self.norms = np.sqrt((self.vectors**2).sum(1))
        rows = np.arange(len(vectors))
        centre = int(np.argmin(((self.vectors - self.vectors.mean(0)) ** 2).sum(1)))
        self.root = self._build(rows, centre, self._distances(rows, centre))

    def _distances(self, rows: np.ndarray, centre: int) -> np.ndarray:
        d = self.vectors[rows] - self.vectors[centre]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    def _scattered(self, rows: np.ndarray, scale: float) -> bool:
        """Whether a child of this scale would hold few of the rows, by some of them."""
        some = rows[:: max(1, len(rows) // TRIES)]
        return sum(int((self._distances(rows, int(i)) <= scale).sum()) for i in some) < FEW * len(some)

    def _build(self, rows: np.ndarray, centre: int, distance: np.ndarray) -> Node:
        """The node of `rows` around `centre`, split until few or equal points are left."""
        radius = float(distance.max())
        node = Node(centre, radius, rows)
        if len(rows) <= LEAF or radius == 0:
            return node
        scale, left, near, at = radius / BASE, rows, distance, centre
        parts, small = [], []
        while len(left):
            # the points within the scale of this centre are its child's; the next centre lies beyond it
            inside = near <= scale
            part = left[inside], at, near[inside]
            few = len(part[0]) < FEW
            (small if few else parts).append(part)
            left, distance = left[~inside], distance[~inside]
            if few and not len(small) % TRIES and self._scattered(left, scale):
                break
            if len(left):
                at = int(left[np.argmax(distance)])
                near = self._distances(left, at)
        if len(left):
            if not parts:
                return node
            rest, at = np.concatenate([own for own, _, _ in small] + [left]), small[0][1]
            node.children.append(Node(at, float(self._distances(rest, at).max()), rest))
        else:
            parts += small
        node.children += [self._build(*part) for part in parts]
        centres = np.array([c.centre for c in node.children])
        node.vectors, node.norms = self.vectors[centres], self.norms[centres]
        node.radii = np.array([c.radius for c in node.children])
        node.split = np.array([bool(c.children) for c in node.children])
        return node


def _bounds(tree: CoverTree, node: Node, parent: Node) -> np.ndarray:
    """The most that a point of a node of `tree` can score with a point of each child of `parent`."""
    inner = parent.vectors @ tree.vectors[node.centre]
    return inner + parent.norms * node.radius + tree.norms[node.centre] * parent.radii + node.radius * parent.radii


NOTHING = np.iinfo(np.int64).min


class Search:
    """The k best points of every query of one tree in another; floor: scores below which a query needs none."""

    def __init__(self, queries: CoverTree, query_ids: np.ndarray, points: CoverTree, ids: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.queries, self.query_ids, self.points, self.ids, self.k = queries, query_ids, points, ids, k
        self.best_score = np.full((len(query_ids), k), NOTHING)
        self.best_id = np.full((len(query_ids), k), np.iinfo(np.int64).max)
        self.floor = np.full(len(query_ids), NOTHING) if floor is None else floor
        most = float(queries.norms.max() * points.norms.max())
        # a type that holds these sums exactly
        kind = np.float32 if most < 2.0**23 else np.float64 if most < 2.0**52 else None
        self.left, self.right = (t.whole if kind is None else t.vectors.astype(kind, copy=False) for t in (queries, points))
        self.slack = 0.5 + most * 1e-9
        self._visit(queries.root, points.root)

    def _need(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.best_score[rows, -1], self.floor[rows])

    def _visit(self, q: Node, r: Node) -> None:
        if not q.children and not r.children:
            self._base(q, r.points)
        elif q.children and (not r.children or q.radius >= r.radius):
            bounds = _bounds(self.points, r, q) + self.slack
            for i in np.argsort(-bounds, kind="stable"):
                c = q.children[i]
                c.worst = max(c.worst, q.worst)
                if bounds[i] >= c.worst:
                    self._visit(c, r)
            q.worst = max(q.worst, min(c.worst for c in q.children))
        else:
            bounds = _bounds(self.queries, q, r) + self.slack
            order = np.argsort(-bounds, kind="stable")
            if not q.children:
                q.worst = max(q.worst, float(self._need(q.points).min()))
                # children that are leaves meet the queries some at a time
                leaves = order[~r.split[order]]
                for i in range(0, len(leaves), TOGETHER):
                    some = leaves[i : i + TOGETHER]
                    some = some[bounds[some] >= q.worst]
                    if not len(some):
                        break
                    self._base(q, np.concatenate([r.children[j].points for j in some]))
                order = order[r.split[order]]
            for i in order:
                if bounds[i] < q.worst:
                    break
                self._visit(q, r.children[i])

    def _base(self, q: Node, points: np.ndarray) -> None:
        for i in range(0, len(points), TOGETHER * LEAF):
            for j in range(0, len(q.points), ABREAST):
                self._block(q.points[j : j + ABREAST], points[i : i + TOGETHER * LEAF])
        q.worst = max(q.worst, float(self._need(q.points).min()))

    def _block(self, rows: np.ndarray, points: np.ndarray) -> None:
        points = points[np.argsort(self.ids[points], kind="stable")]
        ids, own, k = self.ids[points], self.query_ids[rows], self.k
        score = self.left[rows] @ self.right[points].T
        # an equal score may still win by its id
        gains = score >= self._need(rows).astype(score.dtype)[:, None]
        itself = np.flatnonzero(np.isin(ids, own))
        gains[:, itself] &= ids[itself] != own[:, None]
        many = np.flatnonzero(np.count_nonzero(gains, axis=1) > 2 * k)
        if len(many):
            # only the k best of these can stay, of equal ones the first
            mine = gains[many]
            scores = np.where(mine, score[many], NOTHING)
            kth = np.partition(scores, -k, axis=1)[:, -k, None]
            mine &= scores >= kth
            equal = mine & (scores == kth)
            if np.count_nonzero(equal) > 2 * k * len(many):
                mine &= ~equal | (np.cumsum(equal, axis=1) <= k)
            gains[many] = mine
        row, column = np.nonzero(gains)
        if not len(row):
            return
        changed = np.unique(row)
        at = rows[changed]
        row = np.concatenate((row, np.repeat(changed, k)))
        scores = np.concatenate((score[gains].astype(np.int64), self.best_score[at].ravel()))
        found = np.concatenate((ids[column], self.best_id[at].ravel()))
        # of whole numbers, -x - 1 turns the order round without overflow
        order = np.lexsort((found, ~scores, row))
        first = np.searchsorted(row[order], changed)
        order = order[first[:, None] + np.arange(k)]
        self.best_score[at], self.best_id[at] = scores[order], found[order]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all that was found: the query's row, the point's id and the score."""
        found = (self.best_score > NOTHING) | (self.best_id < np.iinfo(np.int64).max)
        row, place = np.nonzero(found & (self.best_score >= self.floor[:, None]))
        return row, self.best_id[row, place], self.best_score[row, place]


def spread(vectors: np.ndarray, most: int) -> np.ndarray:
    """Rows of `most` vectors, or of all distinct ones, each the furthest from those before."""
    chosen, distance = [0], np.full(len(vectors), np.inf)
    while len(chosen) <= most:
        d = vectors - vectors[chosen[-1]]
        distance = np.minimum(distance, np.einsum("ij,ij->i", d, d))
        chosen.append(int(np.argmax(distance)))
        if distance[chosen[-1]] == 0:
            break
    return np.array(chosen[:-1])


@dataclass
class Cells:
    """For each length of vector: pivots; with the covering radius and the number of points of each."""

    pivots: dict[int, np.ndarray]
    radii: dict[int, np.ndarray] = field(default_factory=dict)

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each row and the distance to its pivot; without pivots, one cell around zero."""
        pivots = self.pivots.get(v.shape[1], np.zeros((1, v.shape[1])))
        square = (v**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * v @ pivots.T
        cell = square.argmin(1)
        d = v - pivots[cell]
        return cell, np.sqrt(np.einsum("ij,ij->i", d, d))

    def bounds(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """q . c and what no point of a cell scores more than, for every query and cell; empty cells: -inf."""
        radii = self.radii.get(v.shape[1], np.full(1, -np.inf))
        pivots = self.pivots.get(v.shape[1], np.zeros((1, v.shape[1])))
        inner, norms = v @ pivots.T, np.sqrt((v**2).sum(1))[:, None]
        most = inner + norms * np.where(np.isfinite(radii), radii, 0)
        slack = 0.5 + norms * (np.sqrt((pivots**2).sum(1)) + np.where(np.isfinite(radii), radii, 0)) * 1e-9
        return np.where(np.isfinite(radii), inner, -np.inf), np.where(np.isfinite(radii), most + slack, -np.inf)


def _by_length(frame: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for _, own in frame.groupby(frame["v"].map(len), sort=True):
        yield own, np.stack(own["v"].to_numpy())


def _assign(cells: Cells):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own, v in _by_length(frame):
                cell, distance = cells.nearest(v.astype(np.float64))
                yield own.assign(n=v.shape[1], cell=cell, distance=distance)

    return rows


def _first(cells: Cells):
    """For each query the cell that it meets first."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own, v in _by_length(frame):
                inner, _ = cells.bounds(v.astype(np.float64))
                met = np.isfinite(inner).any(1)
                yield own.assign(n=v.shape[1], cell=inner.argmax(1), floor=NOTHING)[met]

    return rows


def _others(cells: Cells):
    """For each query (with `floor`, its kth score so far) the other cells that may hold a better point."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own, v in _by_length(frame):
                inner, most = cells.bounds(v.astype(np.float64))
                floor = own["floor"].to_numpy().astype(np.float64)[:, None]
                meets = np.isfinite(inner) & (most >= floor)
                meets[np.arange(len(v)), inner.argmax(1)] = False
                row, cell = np.nonzero(meets)
                yield own.iloc[row].assign(n=v.shape[1], cell=cell)

    return rows


RESULT = "query_row long, query_id long, vec_id long, score long"
COLUMNS = ["query_row", "query_id", "vec_id", "score"]


def _meet(k: int):
    def rows(key: tuple, queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(points):
            return pd.DataFrame(columns=COLUMNS).astype("int64")
        ids, row = queries["vec_id"].to_numpy(), queries["query_row"].to_numpy()
        trees = CoverTree(np.stack(queries["v"].to_numpy())), CoverTree(np.stack(points["v"].to_numpy()))
        found = Search(trees[0], ids, trees[1], points["vec_id"].to_numpy(), k, queries["floor"].to_numpy().astype(np.int64))
        i, own, score = found.rows()
        return pd.DataFrame(dict(zip(COLUMNS, (row[i], ids[i], own, score))))

    return rows


def _search(meets: DataFrame, points: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """The k best of each cell for the queries that meet it. A block is paired with so many queries at a time."""
    of = ["n", "cell"]
    tasks = meets.groupBy(*of).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("chunks")).join(counts, of)
    tasks = materialize(tasks, "tasks")
    key = [*of, "block", "chunk"]
    left = meets.join(tasks, of).withColumn("chunk", F.pmod(F.xxhash64("query_row"), F.col("chunks")).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = points.join(tasks, of).withColumn("block", F.pmod(F.xxhash64("vec_id", "salt"), F.col("blocks")).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    left, right = left.select(*key, "query_row", "vec_id", "v", "floor"), right.select(*key, "vec_id", "v")
    return materialize(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_meet(k), RESULT), "met")


def whole(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that take part, as whole numbers."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform(column, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & (F.size(column) > 0) & finite).select(F.col("vec_id").cast("long"), scaled.alias("v"))


def _pivots(points: DataFrame, rows: int) -> Cells:
    """Pivots from the `SAMPLE` vectors with the smallest hash of their id; shared among lengths by their part of it."""
    chosen = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()
    most = min(PIVOTS, -(-rows // EACH))
    return Cells({v.shape[1]: v[spread(v, max(1, most * len(v) // len(chosen)))].astype(np.float64) for _, v in _by_length(chosen)})


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row whose id is divisible by `every`."""
    ship(vectors.sparkSession)
    base = materialize(whole(vectors), "vectors")
    cells = _pivots(base, base.count())
    points = base.mapInPandas(_assign(cells), "vec_id long, v array<long>, n int, cell int, distance double")
    points = materialize(points.withColumn("salt", F.monotonically_increasing_id()), "points")
    counts = materialize(points.groupBy("n", "cell").agg(F.ceil(F.count("*") / POINTS).cast("int").alias("blocks"), F.max("distance").alias("radius")), "cells")
    for r in counts.collect():  # a row for each pivot at most, or length without one
        radii = cells.radii.setdefault(r["n"], np.full(len(cells.pivots.get(r["n"], [0])), -np.inf))
        radii[r["cell"]] = r["radius"]
    counts = counts.drop("radius")
    queries = base.where(F.col("vec_id") % every == 0).distinct().withColumn("query_row", F.xxhash64("vec_id", "v"))
    queries = materialize(queries, "queries")
    meets = "query_row long, vec_id long, v array<long>, floor long, n int, cell int"
    names = ["query_row", "vec_id", "v", "floor", "n", "cell"]
    near = lambda rows: (own[names] for own in _first(cells)(rows))
    first = _search(materialize(queries.mapInPandas(near, meets), "meets"), points, counts, k)
    order = Window.partitionBy("query_row", "query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("query_row", F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    kth = queries.join(kth, ["query_row", "vec_id"], "left").withColumn("floor", F.coalesce("floor", F.lit(int(NOTHING))))
    rest = lambda rows: (own[names] for own in _others(cells)(rows))
    others = _search(materialize(kth.mapInPandas(rest, meets), "meets"), points, counts, k)
    met = first.unionByName(others)
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = f"""
WITH whole AS (SELECT vec_id::BIGINT AS vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, p.vec_id, list_sum(list_transform(list_zip(q.v, p.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM whole q JOIN whole p ON p.vec_id != q.vec_id AND len(p.v) = len(q.v) WHERE q.vec_id % {EVERY} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}"""
