"""Exact top-k inner products by best-first search of an M-tree whose nodes are rows.

The largest inner product is the smallest distance once every candidate is lifted onto one
sphere by a coordinate of its own that queries have as 0, so a metric tree can search for it:

* routing objects, a bounded sample's medoids, part the vectors into cells;
* a cell's vectors, in the order of their distance to its routing object, are cut into pages;
* a page is a row with a routing object, a covering radius, the distance to its parent and
  those between which its members lie, and has leaves that are rows of the same kind.

Blocks of queries visit pages in the order of the smallest possible distance, in a few rounds.
What a round finds bounds what the next ones visit. Stored distances rule out pages, leaves and
members by the triangle inequality before any distance to them is computed.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch

K, SCALE = 10, 1024
#: Routing objects at most, vectors that they are picked from, and vectors of a page, of a leaf and of a block of queries.
CELLS, PICKED, PAGE_ROWS, LEAF_ROWS, BLOCK_ROWS = 512, 8192, 2048, 64, 1024
#: Pages of a partition while the tree is built, and pages that a block may have visited after each round but the last.
PAGES_A_TASK, ROUNDS = 16, (1, 8)
#: Whole numbers up to this are exact as doubles, so sums of products in any order are.
EXACT = float(1 << 53)
#: Relative error allowed for a computed distance.
SLACK = 1e-7

NODE = "page long, node int, cell int, size int, lo double, hi double, radius double, to_parent double, route binary, ids binary, vectors binary, own binary"
HITS = "qkey long, query_id long, id long, score long"


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: whole numbers of each vector that takes part, equal rows once."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine)
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.pow(x.cast("double") * scale, F.lit(2)))
    return held.where(squares < float(1 << 62)).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).distinct()


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between the rows of two matrices."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def lifted(v: np.ndarray, top: float) -> np.ndarray:
    """Vectors as points of the sphere whose squared radius is ``top``."""
    v = v.astype(float)
    return np.hstack([v, np.sqrt(np.maximum(top - (v * v).sum(1), 0))[:, None]])


def level(v: np.ndarray) -> np.ndarray:
    """Queries as points: nearer to what has the larger inner product with them."""
    return np.hstack([v.astype(float), np.zeros((len(v), 1))])


def medoids(points: np.ndarray, n: int, rounds: int = 3) -> np.ndarray:
    """Rows that route to groups of the points: the nearest to each of ``n`` means at most."""
    centre = points[np.unique(np.linspace(0, len(points) - 1, min(n, len(points))).astype(int))]
    for _ in range(rounds):
        near = distances(points, centre).argmin(1)
        kept = np.unique(near)
        sums = np.zeros_like(centre)
        np.add.at(sums, near, points)
        centre = sums[kept] / np.bincount(near, minlength=len(centre))[kept, None]
    return np.unique(distances(centre, points).argmin(1))


def packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def page_of(number: int, cell: int, ids: np.ndarray, v: np.ndarray, to_cell: np.ndarray, pivot: np.ndarray, top: float) -> list[tuple]:
    """The rows of a page: itself, as node -1, and its leaves."""
    points = lifted(v, top)
    middle = medoids(points, 1)[:1]
    from_middle = distances(points, points[middle])[:, 0]
    to_parent = float(distances(points[middle], pivot[None])[0, 0])
    out = [(number, -1, cell, len(ids), float(to_cell.min()), float(to_cell.max()), float(from_middle.max()), to_parent, packed(points[middle]), b"", b"", b"")]
    routes = medoids(points, -(-len(points) // LEAF_ROWS))
    to_route = distances(points, points[routes])
    near = to_route.argmin(1)
    for k, route in enumerate(routes):
        own = np.flatnonzero(near == k)
        if len(own):
            d = to_route[own, k]
            out.append((number, k, cell, len(own), 0.0, 0.0, float(d.max()), float(from_middle[route]), packed(points[route]), packed(ids[own]), packed(v[own]), packed(d)))
    return out


class Best:
    """The ``k`` best of each query so far: the largest scores, of equal ones the smaller ids."""

    def __init__(self, own: np.ndarray, floor: np.ndarray, k: int):
        self.own, self.floor, self.k = own, floor, k
        self.scores = np.full((len(own), k), np.iinfo(np.int64).min)
        self.ids = np.full((len(own), k), np.iinfo(np.int64).max)

    def least(self) -> np.ndarray:
        """A score below which nothing enters any more."""
        return np.maximum(self.scores[:, -1], self.floor)

    def offer(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Candidates for some queries, in a row for each; a query's own row is none."""
        scores = np.where(ids[None, :] == self.own[rows][:, None], np.iinfo(np.int64).min, scores)
        some = (scores >= self.least()[rows][:, None]).any(1)
        rows, scores = rows[some], scores[some]
        scores = np.hstack([self.scores[rows], scores])
        named = np.hstack([self.ids[rows], np.broadcast_to(ids, (len(rows), len(ids)))])
        named = np.where(scores == np.iinfo(np.int64).min, np.iinfo(np.int64).max, named)
        order = np.lexsort((named, ~scores), axis=1)[:, : self.k]  # ~x falls as x grows, and overflows nowhere
        self.scores[rows], self.ids[rows] = np.take_along_axis(scores, order, 1), np.take_along_axis(named, order, 1)


def search(q: np.ndarray, own: np.ndarray, floor: np.ndarray, nodes: list[tuple], top: float, k: int) -> tuple[Best, int]:
    """The best members of one page for a block of queries, and how many distances that took.

    ``floor`` has the scores that earlier pages gave as k-th best, the least integer where there are fewer than ``k``.
    Leaves wait in a queue, those that may hold the nearest member of any query first.
    """
    best, points = Best(own, floor, k), level(q)
    squares = (points * points).sum(1)
    slack = SLACK * (np.sqrt(squares) + np.sqrt(top))
    exact = float if top < EXACT else np.int64
    asked, spent = q.astype(exact), 0

    def reach() -> np.ndarray:
        """A distance beyond which a query needs nothing."""
        least = best.least()
        with np.errstate(invalid="ignore"):
            far = np.sqrt(np.maximum(squares + top - 2 * least.astype(float), 0)) + slack
        return np.where(least == np.iinfo(np.int64).min, np.inf, far)

    whole = next(x for x in nodes if x[1] == -1)
    to_page = distances(points, np.frombuffer(whole[8])[None])[:, 0]
    spent += len(q)
    live = to_page - whole[6] <= reach()
    if not live.any():
        return best, spent
    queue = []
    for x in nodes:
        if x[1] >= 0:  # by stored distances alone
            under = np.maximum(np.abs(to_page - x[7]) - x[6], 0)
            queue.append((float(under[live].min()), x[1], x, under, None))
    heapq.heapify(queue)
    while queue:
        first, name, x, under, to_route = heapq.heappop(queue)
        rows = np.flatnonzero(live & (under <= reach()))
        if not len(rows):
            continue
        if to_route is None:
            to_route = np.full(len(q), np.inf)
            to_route[rows] = distances(points[rows], np.frombuffer(x[8])[None])[:, 0]
            spent += len(rows)
            under = np.maximum(under, to_route - x[6])
            near = float(under[rows].min())
            if queue and near > queue[0][0]:
                heapq.heappush(queue, (near, name, x, under, to_route))
                continue
            rows = rows[under[rows] <= reach()[rows]]
        ids, gap = np.frombuffer(x[9], np.int64), np.frombuffer(x[11])
        may = np.abs(to_route[rows][:, None] - gap[None]) <= reach()[rows][:, None]
        rows, may = rows[may.any(1)], may[may.any(1)]
        if not len(rows):
            continue
        some = np.flatnonzero(may.any(0))
        v = np.frombuffer(x[10], np.int64).reshape(len(ids), -1)[some]
        scores = asked[rows] @ v.T.astype(exact)
        spent += scores.size
        best.offer(rows, ids[some], scores.astype(np.int64))
    return best, spent


class Tree:
    """An M-tree over the vectors that ``integers`` gives, as tables of a folder."""

    def __init__(self, spark: SparkSession, vectors: DataFrame, s: Scratch, k: int = K):
        """``vectors`` is a saved table of ``vec_id, v``. Of equal vectors only those with the ``k + 1`` smallest ids can be among the ``k`` best of any query."""
        self.spark, self.s, self.k = spark, s, k
        one = vectors.agg(F.max(F.size("v")).alias("dims"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("top")).first()
        self.dims, self.top = one["dims"] or 0, one["top"] or 0.0
        first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
        self.members = s.save(vectors.withColumn("v", self.padded()).withColumn("_r", first).where(F.col("_r") <= k + 1).drop("_r"), "members")
        self.size = self.members.count()
        # thinned where the rows are, so that all tasks together send a few times what is picked
        h = F.xxhash64("vec_id", "v")
        few = self.members.where(F.pmod(h, F.lit(1 << 30)) < (1 << 30) * min(1.0, 2 * PICKED / max(self.size, 1)))
        picked = few.orderBy(h, "vec_id", "v").limit(PICKED).toPandas()
        points = lifted(np.stack(picked["v"]), self.top) if len(picked) else np.zeros((0, 1))
        self.routes = points[medoids(points, min(CELLS, -(-self.size // PAGE_ROWS)))] if len(picked) else points
        if self.size:
            self.nodes = s.save(self._pages(), "nodes")

    def padded(self) -> Column:
        """Vectors of all lengths as vectors of the longest's."""
        return F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(self.dims) - F.size("v")))

    def _routed(self, rows: DataFrame, point, schema: str) -> DataFrame:
        """``rows`` with the cell of the nearest routing object and the distance to it."""
        routes, top = self.spark.sparkContext.broadcast(self.routes), self.top

        def route(batches):
            for some in batches:
                if len(some):
                    d = distances(point(np.stack(some["v"]), top), routes.value)
                    near = d.argmin(1)
                    yield some.assign(cell=near.astype(np.int32), to_cell=d[np.arange(len(d)), near])

        return rows.mapInPandas(route, f"{schema}, cell int, to_cell double")

    def _pages(self) -> DataFrame:
        """Rows in the order of cells and distances, dealt by ranges, so that no cell is one task; pages are cut from what is in order."""
        routes, top = self.spark.sparkContext.broadcast(self.routes), self.top
        routed = self.s.save(self._routed(self.members, lifted, "vec_id long, v array<long>"), "routed")
        order = ["cell", "to_cell", "vec_id"]
        dealt = routed.repartitionByRange(max(1, -(-self.size // (PAGE_ROWS * PAGES_A_TASK))), *order).sortWithinPartitions(*order)

        def cut(batches):
            at, held = TaskContext.get().partitionId() << 32, None

            def taken(n):
                nonlocal at, held
                part, held = held.iloc[:n], held.iloc[n:]
                rows = page_of(at, int(part["cell"].iloc[0]), part["vec_id"].to_numpy(), np.stack(part["v"]), part["to_cell"].to_numpy(), routes.value[part["cell"].iloc[0]], top)
                at += 1
                return pd.DataFrame(rows, columns=[c.split()[0] for c in NODE.split(", ")])

            for some in batches:
                held = some if held is None or not len(held) else pd.concat([held, some], ignore_index=True)
                while len(held) and ((run := int((held["cell"] == held["cell"].iloc[0]).sum())) >= PAGE_ROWS or run < len(held)):
                    yield taken(min(run, PAGE_ROWS))
            while held is not None and len(held):
                yield taken(PAGE_ROWS)

        return dealt.mapInPandas(cut, NODE)

    def _blocks(self, queries: DataFrame) -> DataFrame:
        """``queries`` with a block: at most about ``BLOCK_ROWS`` that are nearest to one routing object."""
        numbered = queries.withColumn("qkey", F.monotonically_increasing_id()).withColumn("v", self.padded())
        routed = self.s.save(self._routed(numbered.select("vec_id", "v", "qkey"), lambda v, _: level(v), "vec_id long, v array<long>, qkey long"), "queries")
        counts = routed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("parts"))
        block = F.col("cell").cast("long") * (1 << 32) + F.pmod(F.xxhash64("qkey"), F.col("parts"))
        return self.s.save(routed.join(counts, "cell").withColumn("block", block).drop("parts", "cell", "to_cell"), "blocks")

    def _plan(self, blocks: DataFrame) -> DataFrame:
        """``block, page, under, turn``: how near a page's members may come to a block's queries by stored distances, and its place in that order."""
        routes = self.spark.sparkContext.broadcast(self.routes)

        def spans(some: pd.DataFrame) -> pd.DataFrame:
            d = distances(level(np.stack(some["v"])), routes.value)
            return pd.DataFrame({"block": some["block"].iloc[0], "cell": np.arange(d.shape[1], dtype=np.int32), "least": d.min(0), "most": d.max(0)})

        near = blocks.groupBy("block").applyInPandas(spans, "block long, cell int, least double, most double")
        pages = self.nodes.where("node = -1").select("page", "cell", "lo", "hi", "radius", "to_parent")
        under = F.greatest(F.lit(0.0), F.expr("lo - most"), F.expr("least - hi"), F.expr("to_parent - radius - most"), F.expr("least - radius - to_parent"))
        turn = F.row_number().over(Window.partitionBy("block").orderBy("under", "page"))
        return self.s.save(near.join(pages, "cell").select("block", "page", under.alias("under")).withColumn("turn", turn), "plan")

    def _visit(self, plan: DataFrame, blocks: DataFrame) -> DataFrame:
        """The best members of the planned pages for each query of the blocks that visit them. ``blocks`` has the k-th best score so far as ``floor``."""
        top, k, names = self.top, self.k, [c.split()[0] for c in NODE.split(", ")]

        def visit(asked: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
            floor = np.array([np.iinfo(np.int64).min if f is None else int(f) for f in asked["floor"]])
            own, keys = asked["vec_id"].to_numpy(), asked["qkey"].to_numpy()
            best, _ = search(np.stack(asked["v"]), own, floor, list(nodes[names].itertuples(index=False, name=None)), top, k)
            row, at = np.nonzero((best.scores >= floor[:, None]) & (best.ids != np.iinfo(np.int64).max))
            return pd.DataFrame({"qkey": keys[row], "query_id": own[row], "id": best.ids[row, at], "score": best.scores[row, at]})

        todo = plan.select("block", F.col("page").alias("at"))
        asked = todo.join(blocks.withColumn("floor", F.col("floor").cast("string")), "block").groupBy("block", "at")
        held = todo.select(F.col("block").alias("of"), F.col("at").alias("page")).join(self.nodes, "page").groupBy("of", "page")
        return asked.cogroup(held).applyInPandas(visit, HITS)

    def nearest(self, queries: DataFrame) -> DataFrame:
        """``query_id, rank, vec_id, score`` of the ``k`` largest inner products of each row of ``queries`` (``vec_id, v``) with rows of other ids."""
        place = F.row_number().over(Window.partitionBy("qkey").orderBy(F.col("score").desc(), "id"))
        found = self.spark.createDataFrame([], HITS)
        if self.size:
            blocks = self._blocks(queries)
            plan, before = self._plan(blocks), 0
            for done in (*ROUNDS, None):
                worst = found.groupBy("qkey").agg(F.when(F.count("*") >= self.k, F.min("score")).alias("floor"))
                held = blocks.join(worst, "qkey", "left")
                squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
                room = F.sqrt(F.greatest(squares + self.top - 2.0 * F.col("floor"), F.lit(0.0))) + SLACK * (F.sqrt(squares) + self.top**0.5)
                limit = held.groupBy("block").agg(F.max(F.when(F.col("floor").isNull(), F.lit(float("inf"))).otherwise(room)).alias("room"))
                todo = plan.where(F.col("turn") > before).where(F.lit(True) if done is None else F.col("turn") <= done).join(limit, "block").where("under <= room")
                hits = found.unionByName(self._visit(todo, held))
                found = self.s.save(hits.withColumn("rank", place).where(F.col("rank") <= self.k).drop("rank"), f"found{before}")
                before = done
        return found.select("query_id", place.cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def top_k(spark: SparkSession, vectors: DataFrame, wanted: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest integer inner products of each row that is ``wanted`` (of ``vec_id``) with all other rows.

    Needs ``vec_id`` and ``embedding``, an array of numbers. Components count as ``floor(scale * x)``. Vectors that are null or hold a
    null or non-finite component take no part, nor do rows without a vec_id, nor vectors so
    long (squared length of 2**62 and more) that a long can't hold their scores. Shorter vectors, the empty one too, end in
    zeros. Ties go to the smaller vec_id. Rows with a query's vec_id are its own; equal rows count once, rows
    of equal ids and different vectors each, as queries too. Fewer other rows than ``k`` are all
    returned. An empty table gives no rows; other columns don't matter, whatever their names.
    """
    s = Scratch(spark, "metrictree")
    rows = s.save(integers(vectors, scale), "integers")
    return Tree(spark, rows, s, k).nearest(rows.where(wanted))


#: Brute force: every query against every row.
ORACLE_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
d as (select max(len(v)) n from v),
p as (select vec_id, list_concat(v, list_transform(range(n - len(v)), lambda x: cast(0 as bigint))) v from v, d),
s as (select q.vec_id query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2])) as bigint) score
  from p q join p c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s)
select query_id, cast(rank as integer) rank, vec_id, score from r where rank <= 10
"""
