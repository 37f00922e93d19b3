"""Exact top-k inner products by best-first search in M-trees.

Vectors become integer vectors floor(256 * x). Inner products aren't a metric;
one more coordinate sqrt(M^2 - |a|^2), M the largest length, puts all vectors on
one sphere, where (query with 0 added) distance^2 = |q|^2 + M^2 - 2 <q, a>: the
nearest are those of the largest inner product, and a distance bound is a score
bound. Scores themselves are computed from the integers.

The rows are dealt to the nearest of some routing objects (a bounded sample);
large cells, a heap of equal vectors say, are split by a hash. Each part, about
TREE_ROWS rows, becomes one M-tree in one task: paged nodes with routing
objects, covering radii and distances to the parent. Trees are rows of a table.
Search: a query first runs in its own cell's first tree, which gives it a k-th
score to beat. Queries then go, GROUP_QUERIES of them at most in a task, to the
groups of GROUP_TREES trees that hold one of a cell whose (centre, radius) can
hold a better score. So a tree travels once per GROUP_QUERIES queries and a query
once per group, whatever the number of cells. A task takes blocks of queries
through its trees, the nearest first, and each tree tightens the score to beat.
In a tree the block's queries go down together: a queue holds nodes by the lowest distance
that is possible for one of them; stored parent distances rule entries out
before their distance is computed (|d(q, parent) - d(parent, entry)| bounds it);
an opened page is one matrix product for the queries that still need it; the
search ends when the best node left can't beat any query's k-th score.

Queries: rows whose id is divisible by ``every``; candidates: all rows but those
with the query's own id. Ties go to the smaller id. Vectors that are null,
empty, or hold null or non-finite components, and rows without an id, take no
part; vectors of different lengths never meet (each length present has trees of
its own); equal rows (id and vector) are one row. Fewer
than k candidates give fewer results; an empty table gives no rows; other
columns are left alone.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, prepare, table
from .registry import register
from .vectors import lengths, matrix, unpack, usable

PAGE = 64
TREE_ROWS = 4096
CELLS = 1024
QUERY_BLOCK = 256
#: Trees that a task searches, queries that it takes through them: about 32 and 16 MB at 64 components.
GROUP_TREES, GROUP_QUERIES = 16, 32768
SLACK = 1e-6  # against rounding of distances; scores are exact


class Tree:
    """M-tree over augmented vectors. Node i holds entries lo[i]:hi[i] of
    ``point`` (routing objects of an inner node, rows of a leaf) with their
    distance to the node's own routing object; inner entries name a child and
    its covering radius."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.ids_in, self.points_in = ids, points
        self.lo, self.hi, self.leaf = [], [], []
        self.point, self.up, self.child, self.radius, self.id = [], [], [], [], []
        self.center = points.mean(axis=0)
        self.center_radius = float(np.linalg.norm(points - self.center, axis=1).max(initial=0.0))
        rng = np.random.default_rng(97)
        todo = [(np.arange(len(ids)), self.center, None)]
        sizes = 0
        pending = []
        for rows, routing, slot in todo:
            number = len(self.lo)
            if slot is not None:
                pending.append((slot, number))
            if len(rows) <= PAGE:
                entries, kids, radii = rows, np.full(len(rows), -1), np.zeros(len(rows))
                pts = points[rows]
            else:
                seeds = points[rng.choice(rows, size=min(PAGE, max(2, -(-len(rows) // PAGE))), replace=False)]
                near = distances(points[rows], seeds).argmin(axis=1)
                parts = [rows[near == j] for j in range(len(seeds))]
                if max(map(len, parts)) == len(rows):  # equal points: cut evenly
                    parts = np.array_split(rows, len(seeds))
                keep = [j for j, p in enumerate(parts) if len(p)]
                pts = seeds[keep]
                parts = [parts[j] for j in keep]
                radii = np.array([np.linalg.norm(points[p] - c, axis=1).max() for p, c in zip(parts, pts)])
                entries, kids = np.full(len(parts), -1), np.zeros(len(parts), dtype=np.int64)
                todo.extend((p, c, sizes + j) for j, (p, c) in enumerate(zip(parts, pts)))
            self.lo.append(sizes)
            sizes += len(pts)
            self.hi.append(sizes)
            self.leaf.append(len(rows) <= PAGE)
            self.point.append(pts)
            self.up.append(np.linalg.norm(pts - routing, axis=1))
            self.child.append(kids)
            self.radius.append(radii)
            self.id.append(np.where(entries >= 0, ids[entries], -1) if len(rows) <= PAGE else entries)
        self.point = np.vstack(self.point)
        self.up, self.child, self.radius, self.id = (np.concatenate(x) for x in (self.up, self.child, self.radius, self.id))
        for slot, number in pending:
            self.child[slot] = number
        del self.ids_in, self.points_in

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, beat: np.ndarray, longest: float) -> list[tuple[int, int, int]]:
        """(row of ``queries``, score, id): up to k a query, of score ``beat``
        or more. The queries go down together: the queue holds nodes by the
        lowest distance that any of them could find there, and a page that is
        opened is one matrix product for the queries that still need it.
        One lifted query (a vector ending in 0, ``longest`` with its own square)
        gives (score, id)."""
        if queries.ndim == 1:
            q = queries[:-1]
            got = self.search(np.array([own]), q[None], k, np.array([beat], dtype=np.float64), longest - float(q @ q))
            return [(s, i) for _, s, i in got]
        size = np.sqrt((queries * queries).sum(axis=1))
        reach = size * size + longest  # distance^2 = reach - 2 * score
        least = np.array(beat, dtype=np.float64)
        best = np.full((len(queries), k), -math.inf)
        ids = np.full((len(queries), k), np.iinfo(np.int64).max)

        def far(of: np.ndarray) -> np.ndarray:
            """Distance beyond which no score reaches ``of``."""
            with np.errstate(invalid="ignore"):
                return np.where(np.isneginf(of), math.inf, np.sqrt(np.maximum(reach - 2 * of, 0.0)) * (1 + SLACK) + SLACK)

        limit = far(least)
        d0 = distances(np.column_stack([queries, np.zeros(len(queries))]), self.center[None])[:, 0]
        # the ball |p - c| <= r holds before the coordinate was added too: scores there are <q, c> + |q| r at most
        highest = queries @ self.center[:-1] + size * self.center_radius
        low = np.maximum(d0 - self.center_radius, np.sqrt(np.maximum(reach - 2 * highest, 0.0)) * (1 - SLACK) - SLACK)
        queue, pushed = [(float(low.min(initial=math.inf)), 0, 0, low, d0)], 0
        while queue:
            lowest, _, node, low, d_up = heapq.heappop(queue)
            if lowest > limit.max(initial=0.0):
                break
            need = np.flatnonzero(low <= limit)
            if not len(need):
                continue
            s = slice(self.lo[node], self.hi[node])
            # what the stored parent distances leave
            bound = np.abs(d_up[need] - self.up[s][:, None]) - self.radius[s][:, None]
            open_ = np.flatnonzero((bound <= limit[need]).any(axis=1)) + s.start
            if not len(open_):
                continue
            scores = queries[need] @ self.point[open_, :-1].T
            if self.leaf[node]:
                scores[own[need][:, None] == self.id[open_][None]] = -math.inf
                better = (scores >= least[need][:, None]) & (scores > -math.inf)
                some = np.flatnonzero(better.any(axis=1))
                if not len(some):
                    continue
                rows = need[some]
                found = np.where(better[some], scores[some], -math.inf)
                all_scores = np.concatenate([best[rows], found], axis=1)
                all_ids = np.concatenate([ids[rows], np.where(np.isneginf(found), np.iinfo(np.int64).max, self.id[open_][None])], axis=1)
                first = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
                best[rows], ids[rows] = np.take_along_axis(all_scores, first, 1), np.take_along_axis(all_ids, first, 1)
                least[rows] = np.maximum(least[rows], best[rows, -1])
                limit = far(least)
            else:
                d = np.sqrt(np.maximum(reach[need] - 2 * scores.T, 0.0))
                radius = self.radius[open_][:, None]
                highest = scores.T + size[need] * radius
                lows = np.maximum(d - radius, np.sqrt(np.maximum(reach[need] - 2 * highest, 0.0)) * (1 - SLACK) - SLACK)
                can = lows <= limit[need]
                for i in np.flatnonzero(can.any(axis=1)):
                    child_low, child_up = np.full(len(queries), math.inf), np.zeros(len(queries))
                    child_low[need], child_up[need] = np.where(can[i], lows[i], math.inf), d[i]
                    pushed += 1
                    heapq.heappush(queue, (float(child_low.min()), pushed, int(self.child[open_[i]]), child_low, child_up))
        return [(int(q), int(best[q, j]), int(ids[q, j])) for q, j in zip(*np.nonzero(best > -math.inf))]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0.0))


def lift(points: np.ndarray, longest: float) -> np.ndarray:
    """The added coordinate that puts all points at length ``longest``."""
    return np.column_stack([points, np.sqrt(np.maximum(longest - (points * points).sum(1), 0.0))])


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score."""
    v = F.col(f"`{vector_col}`")
    rows = vectors.where(usable(v) & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * 256).cast("double")).alias("v"))
    rows = materialise(rows.distinct())
    found = [top_k_of_length(rows.where(F.size("v") == dim), dim, k, every) for dim in lengths(rows, "v")]
    return reduce(DataFrame.unionAll, found)


def top_k_of_length(rows: DataFrame, dim: int, k: int, every: int) -> DataFrame:
    """``top_k`` of rows (id, v) whose vectors have ``dim`` components."""
    spark = rows.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    n, longest = rows.agg(F.count(F.lit(1)), F.max(square)).first()
    longest = float(longest or 0.0)
    # routing objects: a bounded sample, the first by hash; beyond CELLS * TREE_ROWS rows a cell has more trees, not larger ones
    cells = min(CELLS, max(1, math.ceil(n / TREE_ROWS)))
    seeds = rows.orderBy(F.xxhash64("id", "v"), "id").limit(cells).select("v").toPandas()["v"]
    centers = spark.sparkContext.broadcast(lift(matrix(seeds), longest) if len(seeds) else np.zeros((1, dim + 1)))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                points = matrix(pdf["v"])
                lifted = lift(points, longest)
                cell = distances(lifted, centers.value).argmin(axis=1)
                yield pd.DataFrame({"id": pdf["id"], "cell": cell, "away": np.linalg.norm(lifted - centers.value[cell], axis=1),
                                    "point": [p.tobytes() for p in points]})

    dealt = materialise(rows.mapInPandas(deal, "id long, cell long, away double, point binary"))
    # a cell's trees are drawn from it by hash and share its ball: the directory has at most CELLS rows
    cells_of = materialise(dealt.groupBy("cell").agg(F.max("away").alias("radius"), F.ceil(F.count(F.lit(1)) / TREE_ROWS).alias("parts")))
    balls = cells_of.toPandas().sort_values("cell")
    placed = dealt.join(F.broadcast(cells_of.select("cell", "parts")), "cell").withColumn("part", F.pmod(F.xxhash64("id", "point"), "parts"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(pdf["id"].to_numpy(), lift(unpack(pdf["point"]), longest))
        return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "part": [pdf["part"].iloc[0]], "tree": [pickle.dumps(tree)]})

    trees = materialise(placed.groupBy("cell", "part").applyInPandas(build, "cell long, part long, tree binary"))
    queries = materialise(dealt.where(F.col("id") % every == 0).select(F.monotonically_increasing_id().alias("q"), "id", "cell", "point"))
    parts = balls["parts"].to_numpy(dtype=np.int64)
    before, count = np.cumsum(parts) - parts, int(parts.sum())
    # a tree a task where trees are few
    groups = max(1, min(count, max(4 * spark.sparkContext.defaultParallelism, -(-count // GROUP_TREES))))
    chunks = max(1, -(-queries.count() // GROUP_QUERIES))
    told = spark.sparkContext.broadcast((balls["cell"].to_numpy(), centers.value[balls["cell"]], balls["radius"].to_numpy(), before, parts))

    def search(forest: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """Hits of ``asked`` (q, id, home, beat, point) in the trees (cell, part, tree),
        but for a query's first tree where it has a score to beat."""
        forest = [(cell, part, pickle.loads(tree)) for cell, part, tree in zip(forest["cell"], forest["part"], forest["tree"])]
        asked = asked.sort_values(["home", "q"])
        found = []
        for at in range(0, len(asked) if forest else 0, QUERY_BLOCK):
            block = asked.iloc[at:at + QUERY_BLOCK]
            points, own, home = unpack(block["point"]), block["id"].to_numpy(), block["home"].to_numpy()
            beat, done = block["beat"].to_numpy(dtype=np.float64), block["searched"].to_numpy()
            best = np.full((len(block), k), -math.inf)
            ids = np.full((len(block), k), np.iinfo(np.int64).max)
            middle = np.append(points.mean(axis=0), 0.0)
            for cell, part, tree in sorted(forest, key=lambda t: (float(np.linalg.norm(t[2].center - middle)), t[0], t[1])):
                use = np.flatnonzero(~done | (home != cell) | (part != 0))
                if not len(use):
                    continue
                got = tree.search(own[use], points[use], k, beat[use], longest)
                if not got:
                    continue
                hit = np.full((len(block), 2 * k), -math.inf)
                hit_ids = np.full((len(block), 2 * k), np.iinfo(np.int64).max)
                hit[:, :k], hit_ids[:, :k] = best, ids
                filled = np.full(len(block), k)
                for i, score, other in got:
                    i = use[i]
                    hit[i, filled[i]], hit_ids[i, filled[i]] = score, other
                    filled[i] += 1
                first = np.lexsort((hit_ids, -hit), axis=1)[:, :k]
                best, ids = np.take_along_axis(hit, first, 1), np.take_along_axis(hit_ids, first, 1)
                beat = np.maximum(beat, best[:, -1])
            rows, places = np.nonzero(best > -math.inf)
            found.append(pd.DataFrame({"q": block["q"].to_numpy()[rows], "query_id": own[rows], "vec_id": ids[rows, places],
                                       "score": best[rows, places].astype(np.int64)}))
        return pd.concat(found) if found else pd.DataFrame(columns=["q", "query_id", "vec_id", "score"])

    shape = "q long, query_id long, vec_id long, score long"
    # queries of a cell that has many go through its first tree in several tasks
    slices = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / GROUP_QUERIES).alias("slices"))
    homes = trees.where("part = 0").join(F.broadcast(slices), "cell").select("cell", "part", "tree", F.explode(F.sequence(F.lit(0), F.col("slices").cast("int") - 1)).alias("slice"))
    at_home = queries.join(F.broadcast(slices), "cell").select(
        "q", "id", F.col("cell").alias("home"), F.lit(float("-inf")).alias("beat"), F.lit(False).alias("searched"), "point",
        F.pmod(F.xxhash64("q"), "slices").cast("int").alias("slice"))
    first = materialise(homes.groupBy("cell", "slice").cogroup(at_home.groupBy("home", "slice")).applyInPandas(search, shape))
    worst = first.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
    worst = worst.select("q", F.when(F.col("n") >= k, F.col("worst").cast("double")).otherwise(float("-inf")).alias("beat"))
    again = queries.join(worst, "q", "left").select(
        "q", "id", F.col("cell").alias("home"), F.coalesce("beat", F.lit(float("-inf"))).alias("beat"), F.lit(True).alias("searched"), "point")

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Queries with the groups that can hold a better score for them."""
        cell, center, radius, before, parts = told.value
        tree_of = np.repeat(np.arange(len(cell)), parts)
        # where the trees of a group come from: tree number t, of cell tree_of[t], is in group t % groups
        held = np.zeros((len(cell), groups), dtype=bool)
        held[tree_of, np.arange(len(tree_of)) % groups] = True
        for pdf in batches:
            for at in range(0, len(pdf), 64):
                some = pdf.iloc[at:at + 64]
                points = unpack(some["point"])
                reach = (points * points).sum(1)[:, None] + longest
                d = distances(np.column_stack([points, np.zeros(len(points))]), center)
                low = np.maximum(d * (1 - SLACK) - radius - SLACK, 0.0)
                # by the distance on the sphere, and by the ball without the added coordinate
                highest = np.minimum((reach - low * low) / 2, points @ center[:, :-1].T + np.sqrt(reach - longest) * radius) * (1 + SLACK) + SLACK
                can = highest >= some["beat"].to_numpy()[:, None]
                # the first tree of its own cell has been searched
                can[np.arange(len(some)), np.searchsorted(cell, some["home"])] &= parts[np.searchsorted(cell, some["home"])] > 1
                rows, to = np.nonzero(can.astype(np.float32) @ held.astype(np.float32))
                if len(rows):
                    yield some.iloc[rows].assign(group=to, chunk=some["q"].to_numpy()[rows] % chunks)

    routed = again.mapInPandas(route, "q long, id long, home long, beat double, searched boolean, point binary, group long, chunk long")
    numbers = spark.createDataFrame(pd.DataFrame({"cell": balls["cell"].astype("int64"), "before": before}), "cell long, before long")
    grouped = trees.join(F.broadcast(numbers), "cell").select(
        "cell", "part", "tree", F.pmod(F.col("before") + F.col("part"), F.lit(groups)).cast("long").alias("group"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"))
    others = grouped.groupBy("group", "chunk").cogroup(routed.groupBy("group", "chunk")).applyInPandas(search, shape)
    place = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return (first.unionAll(others).distinct().withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = """
WITH e AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS a FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(generate_series(1, len(q.a)), lambda i: q.a[i] * c.a[i]))::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.a) = len(q.a)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5"""


@register("op1_mtree_topk", ORACLE)
def op1_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows for every 50th embedding."""
    prepare(spark)
    return top_k(table(spark, sf_dir, "embeddings"))
