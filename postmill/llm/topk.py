"""Exact top-k by inner product with two cover trees.

Queries and rows are both indexed. In a tree a node has a center, one of its points, and a covering radius, the
largest distance of its points from it. A node of more than ``LEAF`` points always gives way to children: centers, its own first,
that are more than ``1 / BASE`` of its radius apart, each with the points within that distance; so covers are nested and radii
fall from level to level. For a node of queries (center q, radius r, longest point A) and one of rows (center p, radius s, longest point B) no
inner product exceeds ``q.p + r|p| + s|q| + rs``, nor ``(A^2 + B^2 - max(0, |q - p| - r - s)^2) / 2``. The tree of queries is
walked from its root with the nodes of rows that are left for the group; of both sides the wider node gives way to its children. A pair of nodes is
passed over when its bound is below the worst k-th score any query of the group has so far; what is left for a leaf of
queries is multiplied out best bound first, in growing portions, and the bound is looked at again before each.

On Spark, queries are cut into blocks of about ``QUERIES`` and rows into ``SLICES`` slices and one more per ``ROWS`` rows, both by a
hash of the id. Each cell (block, slice) is a sorted run of one task's rows: the block's queries come first and are indexed, then
the slice's rows stream by in chunks, each indexed and searched with the k-th scores found so far. A cell
sends at most k rows per query, and a last ranking merges the cells. No pairs are emitted.

Scores are integers. They are computed in float64 where the norms prove that exact, and in Python's integers where not;
scores beyond 64 bits are clipped to that range, scaled components to that of a double.

Defined results: vectors that are null or hold a null or non-finite component, and rows without id, take no part. Vectors are
compared with those of their own length. Rows that repeat an id count once, with the least vector. Ties go to the smaller id.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 20
SCALE = 64
QUERIES = 8192
# Every cell returns up to k rows of a query, so few large slices send less; ROWS bounds what one task sorts.
SLICES = 16
ROWS = 1 << 18
CHUNK = 4096
# Smaller leaves prune more and cost more: of 51,282 given vectors 512 passes over 2 % of the pairs of nodes in 4.6 s, 128 11 % in 18 s.
LEAF = 512
BASE = 1.1
# Rows multiplied out at first for a leaf of queries; each portion is twice the last.
PORTION = 256
LARGEST = float(np.finfo(np.float64).max)


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers from each first to its last, one range after the other."""
    sizes = last - first
    return np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)


class CoverTree:
    """Points in the order of the tree; node n has ``order[first[n]:last[n]]``, its center first, and children ``begin[n]`` to ``end[n]``."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, base: float = BASE):
        self.points = points.astype(np.float64)
        self.leaf, self.base = leaf, base
        self.order = np.arange(len(points))
        # Lengths and distances beyond a double are infinite, and so are their bounds.
        with np.errstate(over="ignore", invalid="ignore"):
            self.norms = np.sqrt(np.einsum("ij,ij->i", self.points, self.points))
            first, last, radius, begin, end = [0], [len(points)], [0.0], [], []
            if len(points):
                radius[0] = float(self._distances(0, self.order).max())
            for node in range(2 * len(points) + 1):
                if node == len(first):
                    break
                begin.append(len(first))
                for start, stop, reach in self._split(first[node], last[node], radius[node]):
                    first.append(start)
                    last.append(stop)
                    radius.append(reach)
                end.append(len(first))
        self.first, self.last, self.radius = np.array(first), np.array(last), np.array(radius)
        self.begin, self.end = np.array(begin), np.array(end)
        self.centers = self.order[self.first] if len(points) else self.first[:0]
        self.longest = np.array([self.norms[self.order[a:b]].max(initial=0) for a, b in zip(first, last, strict=True)])

    def _distances(self, center: int, rows: np.ndarray) -> np.ndarray:
        squares = self.norms[rows] ** 2 + self.norms[center] ** 2
        # Rounded up, so that a bound stays a bound.
        apart = np.sqrt(np.maximum(squares - 2 * (self.points[rows] @ self.points[center]), 0) + 1e-12 * squares)
        return np.where(np.isnan(apart), np.inf, apart)

    def _split(self, first: int, last: int, radius: float) -> list[tuple[int, int, float]]:
        """First, last and radius of the children; none for a leaf, which is small or holds copies of one point."""
        rows = self.order[first:last].copy()
        if len(rows) <= self.leaf or not np.isfinite(radius) or radius <= 1e-5 * self.norms[rows[0]]:
            return []
        children = []
        while len(rows):
            far = self._distances(int(rows[0]), rows)
            near = far <= radius / self.base
            near[0] = True
            group = rows[near]
            self.order[first : first + len(group)] = group
            children.append((first, first + len(group), float(far[near].max()) if len(group) > 1 else 0.0))
            first += len(group)
            rows = rows[~near]
        return children


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b`` (integers as float64)."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    most = np.abs(a).sum(axis=1).max() * np.abs(b).max(initial=0)
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = np.array([[int(x) for x in row] for row in a.tolist()], dtype=object).reshape(a.shape)
    other = np.array([[int(x) for x in row] for row in b.tolist()], dtype=object).reshape(b.shape)
    found = whole @ other.T
    return np.clip(found, -(2**63), 2**63 - 1).astype(np.int64)


class Search:
    """The best k rows so far of each query of a block.

    ``pairs`` counts the pairs of nodes whose bound was looked at, ``pruned`` those passed over, ``products`` the scores computed.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, leaf: int = LEAF):
        self.leaf, self.tree = leaf, CoverTree(vectors, leaf)
        self.ids, self.k = ids, k
        with np.errstate(over="ignore"):
            self.largest_sum = np.abs(self.tree.points).sum(axis=1).max(initial=0)
        # Worse than any score; a free place is known by its id.
        self.scores = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.worst = np.full(len(ids), -np.inf)
        self.pairs = self.pruned = self.products = 0

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Search a chunk of rows."""
        if not len(ids) or not len(self.ids):
            return
        rows, tree = CoverTree(vectors, self.leaf), self.tree
        is_small = self.largest_sum * np.abs(rows.points).max(initial=0) < 2.0**53
        # A group of queries with the nodes of rows that its parent left.
        open_ = [(0, np.zeros(1, np.int64))]
        while open_:
            group, nodes = open_.pop()
            is_leaf = tree.begin[group] == tree.end[group]
            nodes = self._left(group, nodes, rows)
            while True:
                wide = (rows.begin[nodes] < rows.end[nodes]) & (is_leaf | (rows.radius[nodes] >= tree.radius[group]))
                if not wide.any():
                    break
                below = _ranges(rows.begin[nodes[wide]], rows.end[nodes[wide]])
                nodes = np.concatenate([nodes[~wide], self._left(group, below, rows)])
            if is_leaf:
                self._leaf(group, nodes, rows, ids, is_small)
            elif len(nodes):
                open_.extend((child, nodes) for child in range(tree.end[group] - 1, tree.begin[group] - 1, -1))

    def _left(self, group: int, nodes: np.ndarray, rows: CoverTree) -> np.ndarray:
        """The nodes that may hold one of the best k rows of a query of the group."""
        left = nodes[self._bounds(group, nodes, rows) >= self._bar(group)]
        self.pairs += len(nodes)
        self.pruned += len(nodes) - len(left)
        return left

    def _bar(self, group: int) -> float:
        """The worst k-th score of the queries of a group."""
        return float(self.worst[self.tree.order[self.tree.first[group] : self.tree.last[group]]].min())

    def _bounds(self, group: int, nodes: np.ndarray, rows: CoverTree) -> np.ndarray:
        """No product of a query of the group and a row of the node is larger."""
        center, r, longest = self.tree.centers[group], self.tree.radius[group], self.tree.longest[group]
        length, lengths, s = self.tree.norms[center], rows.norms[rows.centers[nodes]], rows.radius[nodes]
        with np.errstate(over="ignore", invalid="ignore"):
            products = rows.points[rows.centers[nodes]] @ self.tree.points[center]
            by_radii = products + r * lengths + s * length + r * s
            squares = length**2 + lengths**2
            # Distances rounded down here.
            gap = np.maximum(np.sqrt(np.maximum(squares - 2 * products - 1e-12 * squares, 0)) - r - s, 0)
            by_distance = (longest**2 + rows.longest[nodes] ** 2 - gap**2) / 2
            # Room for rounding, so that an equal score is not passed over.
            bounds = np.minimum(by_radii, by_distance) + 1e-9 * (squares + longest**2 + rows.longest[nodes] ** 2 + r * s) + 1e-9
        return np.where(np.isfinite(bounds), bounds, np.inf)

    def _leaf(self, group: int, nodes: np.ndarray, rows: CoverTree, ids: np.ndarray, is_small: bool) -> None:
        """Multiply a leaf of queries out with nodes of rows, best bound first, until no bound reaches the group's bar."""
        mine = self.tree.order[self.tree.first[group] : self.tree.last[group]]
        bounds = self._bounds(group, nodes, rows)
        by_bound = np.argsort(-bounds, kind="stable")
        nodes, bounds = nodes[by_bound], bounds[by_bound]
        ends = np.cumsum(rows.last[nodes] - rows.first[nodes])
        at, portion = 0, PORTION
        while at < len(nodes):
            left = int(np.searchsorted(-bounds, -self._bar(group), side="right"))
            if left <= at:
                self.pruned += len(nodes) - at
                return
            size = ends[at - 1] if at else 0
            stop = min(left, int(np.searchsorted(ends, size + portion)) + 1)
            theirs = rows.order[_ranges(rows.first[nodes[at:stop]], rows.last[nodes[at:stop]])]
            mine_, theirs_ = self.tree.points[mine], rows.points[theirs]
            scores = (mine_ @ theirs_.T).astype(np.int64) if is_small else exact_products(mine_, theirs_)
            self._merge(mine, scores, ids[theirs])
            self.products += len(mine) * len(theirs)
            at, portion = stop, portion * 2

    def _merge(self, mine: np.ndarray, scores: np.ndarray, candidates: np.ndarray) -> None:
        """Merge the scores of some queries with some rows into the best so far."""
        query, place = np.nonzero(scores >= self.worst[mine][:, None])
        s, i, query = scores[query, place], candidates[place], mine[query]
        better = ((s > self.worst[query]) | (i < self.found[query, -1])) & (i != self.ids[query])
        s, i, query = s[better], i[better], query[better]
        if not len(query):
            return
        mine = np.unique(query)
        s = np.concatenate([self.scores[mine].ravel(), s])
        i = np.concatenate([self.found[mine].ravel(), i])
        query = np.concatenate([np.repeat(mine, self.k), query])
        # A free place has the largest id and the least score, and so comes last; ~s falls where s rises, and never overflows.
        best = np.lexsort((i, ~s, query))
        taken = best[(np.searchsorted(query[best], mine)[:, None] + np.arange(self.k)).ravel()]
        self.scores[mine], self.found[mine] = s[taken].reshape(len(mine), self.k), i[taken].reshape(len(mine), self.k)
        full = self.found[mine, -1] != np.iinfo(np.int64).max
        self.worst[mine[full]] = self.scores[mine[full], -1]

    def result(self) -> pa.RecordBatch:
        query, place = np.nonzero(self.found != np.iinfo(np.int64).max)
        return pa.RecordBatch.from_pydict(
            {"query_id": self.ids[query], "vec_id": self.found[query, place], "score": self.scores[query, place]}
        )


def scaled(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Ids and integer vectors ``floor(scale * x)`` of the rows that take part, one per id."""
    vector = F.transform(vector_column, lambda x: x.cast("double"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(whole)
    # Doubles, since a component may be beyond a long; they hold whole numbers.
    wide = F.transform("v", lambda x: _floor(F.greatest(F.least(x * scale, F.lit(LARGEST)), F.lit(-LARGEST))))
    return rows.select("vec_id", wide.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _floor(x: Column) -> Column:
    # From 2**53 on a double is whole, and floor() would not fit a long.
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def top_k(
    vectors: DataFrame, queries: Column, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding",
    queries_per_block: int = QUERIES, least_slices: int = SLICES, rows_per_slice: int = ROWS,
) -> DataFrame:
    """The k best rows of each row for which ``queries`` (over ``vec_id``) holds: query_id, rank, vec_id, score."""
    rows = scaled(vectors, id_column, vector_column)
    # Two counts size the grid; rows are never dropped by it.
    total, asked = vectors.filter(F.col(id_column).isNotNull()).select(F.count("*"), F.count_if(queries)).first()
    slices_ = least_slices + total // rows_per_slice
    blocks = max(1, -(-asked // queries_per_block))
    place = F.xxhash64("vec_id")
    by_block = F.pmod(place, F.lit(blocks)).cast("int")
    by_slice = F.pmod(F.shiftright(place, 20), F.lit(slices_)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dimension = F.size("v").alias("dimension")
    asking = rows.filter(queries).select("vec_id", "v", dimension, by_block.alias("block"), every(slices_).alias("slice"), F.lit(0).alias("kind"))
    offered = rows.select("vec_id", "v", dimension, every(blocks).alias("block"), by_slice.alias("slice"), F.lit(1).alias("kind"))
    cells = asking.unionByName(offered)
    key = ["dimension", "block", "slice"]
    dealt = cells.repartition(*key).sortWithinPartitions(*key, "kind", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunks in _cells(batches):
            yield from _search_cell(chunks, k)

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[pa.RecordBatch]]:
    """Runs of batches of the same cell, one after the other."""
    parts = _parts(batches)
    part = next(parts, None)
    while part is not None:
        cell = part[0]

        def own() -> Iterator[pa.RecordBatch]:
            nonlocal part
            while part is not None and part[0] == cell:  # noqa: B023
                yield part[1]
                part = next(parts, None)

        runs = own()
        yield runs
        for _ in runs:
            pass


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Batches cut where the cell changes, and into chunks of bounded size."""
    for batch in batches:
        keys = np.stack([batch[c].to_numpy() for c in ("dimension", "block", "slice")], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), len(batch)]
        for start, stop in zip(bounds, bounds[1:], strict=False):
            for at in range(start, stop, CHUNK):
                yield tuple(keys[start].tolist()), batch.slice(at, min(CHUNK, stop - at))


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    dimension = batch["dimension"][0].as_py()
    flat = batch["v"].flatten().to_numpy(zero_copy_only=False)
    return batch["vec_id"].to_numpy(), flat.reshape(len(batch), dimension)


def _search_cell(chunks: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Queries first, as the run is sorted; then rows, a chunk at a time."""
    asking: list[tuple[np.ndarray, np.ndarray]] = []
    search = None
    for chunk in chunks:
        kind = chunk["kind"].to_numpy()
        split = int(np.searchsorted(kind, 1))
        if split:
            asking.append(_matrix(chunk.slice(0, split)))
        if split < len(chunk) and asking:
            if search is None:
                search = Search(np.concatenate([a[0] for a in asking]), np.concatenate([a[1] for a in asking]), k)
            search.add(*_matrix(chunk.slice(split)))
    if search is not None:
        yield search.result()
