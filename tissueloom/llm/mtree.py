"""Exact top-k by inner product with M-tree best-first search.

Vectors become whole numbers and get one more coordinate, so that all of a block have the same norm:
then the largest inner product is the smallest Euclidean distance, and the metric tree's bounds hold.
The tree's top level are routing objects drawn from the rows; each row belongs to its nearest, and the rows of one
make a subtree, in blocks of bounded size.  A block is an M-tree of paged nodes, stored one row a
node: the entries' vectors, covering radii and distances to the node's own routing object.  A search visits
nodes by their smallest possible distance and computes an entry's distance only if the stored distances
cannot rule it out.  A query first meets the nearest subtrees that hold enough rows, which gives it a score to beat,
then only the subtrees whose covering radius reaches in.
"""

from __future__ import annotations

import heapq
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueloom.sources.storage import materialise

#: Vectors in a block, entries in a node, queries that meet a block together, routing objects of one vector length.
BLOCK_ROWS, PAGE, QUERY_ROWS, MAX_ROUTING = 16_384, 128, 8_192, 4_096
NODE = (
    "dim int, subtree int, block int, node int, leaf boolean, ids array<bigint>, items binary, "
    "radius array<double>, parent array<double>"
)


class Routing(NamedTuple):
    """The top level for one vector length: routing objects with the coordinate that lifts them, what they hold."""

    objects: np.ndarray
    top: float  #: the largest squared norm
    rows: np.ndarray
    radius: np.ndarray


def quantized(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, dim, v``: floor(256 x); rows without an id or with a null or non-finite part are out."""
    as_double = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), as_double.alias("v"))
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound)
        .select("vec_id", F.size("v").alias("dim"), F.transform("v", lambda x: F.floor(x * 256)).alias("v"))
    )


def lifted(points: np.ndarray) -> np.ndarray:
    """Points with the coordinate that gives all of them the largest norm."""
    square = (points.astype(float) ** 2).sum(axis=1)
    return np.c_[points, np.sqrt(np.maximum(square.max(initial=0) - square, 0))]


def build_tree(ids: np.ndarray, points: np.ndarray):
    """Nodes ``(node, leaf, ids or children, entry points, radii, parent distances)``; node 0 is the root.

    Bulk loading: a set larger than a page is dealt to the nearest of ``PAGE`` routing objects taken at
    even steps, then each part is treated alike; equal points are cut by position.
    """
    full = lifted(points)
    nodes: list = []

    def make(rows: np.ndarray, centre: np.ndarray | None) -> int:
        number = len(nodes)
        nodes.append(None)
        far = np.zeros(len(rows)) if centre is None else np.linalg.norm(full[rows] - centre, axis=1)
        if len(rows) <= PAGE:
            nodes[number] = (number, True, ids[rows], points[rows], np.zeros(len(rows)), far)
            return number
        heads = rows[np.linspace(0, len(rows) - 1, min(PAGE, -(-len(rows) // (PAGE // 2)))).astype(int)]
        square = (full[rows] ** 2).sum(axis=1)[:, None] + (full[heads] ** 2).sum(axis=1) - 2 * full[rows] @ full[heads].T
        near = square.argmin(axis=1)
        groups = [(full[heads[k]], heads[k], rows[near == k]) for k in range(len(heads)) if (near == k).any()]
        if len(groups) == 1:  # all equal, or as good as equal: cut by position
            groups = [(full[part[0]], part[0], part) for part in np.array_split(rows, min(PAGE, -(-len(rows) // PAGE)))]
        children, radii, centres = [], [], []
        for head, who, part in groups:
            radii.append(np.linalg.norm(full[part] - head, axis=1).max())
            children.append(make(part, head))
            centres.append(who)
        centres = np.array(centres)
        far = np.zeros(len(centres)) if centre is None else np.linalg.norm(full[centres] - centre, axis=1)
        nodes[number] = (number, False, np.array(children), full[centres], np.array(radii), far)
        return number

    make(np.arange(len(ids)), None)
    return nodes


def search(
    nodes: dict[int, tuple], top: float, query_id: int, query: np.ndarray, k: int, exact, floor: int | None = None
) -> list[tuple[int, int]]:
    """The ``k`` best ``(score, vec_id)`` of one block: higher scores first, then smaller ids.

    ``nodes``: number to (leaf, ids, entry points, radii, parent distances); ``top``: the squared norm of the block;
    ``floor``: a score below which nothing is wanted.
    """
    own = float((query.astype(float) ** 2).sum())
    slack = 1e-6 * (1 + own + top) ** 0.5
    best: list[tuple[int, int]] = []  # a heap of (score, -id): its head is the worst kept
    limit = math.inf  # distance beyond which nothing can be kept
    if floor is not None:
        if own + top - 2 * floor < -slack * slack:
            return []
        limit = math.sqrt(max(own + top - 2 * floor, 0)) + slack
    bound = limit
    # (smallest possible distance, node, distance to the node's routing object or None)
    queue: list[tuple[float, int, float | None]] = [(0.0, 0, None)]
    lifted_query = np.r_[query.astype(float), 0.0]
    while queue:
        low, number, to_centre = heapq.heappop(queue)
        if low > limit:
            break
        leaf, ids, entries, radii, parent = nodes[number]
        rows = np.arange(len(ids))
        if to_centre is not None:  # stored distances rule entries out before any computation
            rows = np.flatnonzero(np.abs(to_centre - parent) - radii <= limit)
        if not len(rows):
            continue
        if leaf:
            whole = len(rows) == len(ids)
            scores = exact(entries if whole else entries[rows], query)
            least = best[0][0] if len(best) == k else floor
            if least is not None:  # ties with the worst kept still compete by id
                good = np.flatnonzero(scores >= least)
                rows, scores = rows[good], scores[good]
            for score, who in zip(scores.tolist(), ids[rows].tolist()):
                if who == query_id:
                    continue
                entry = (int(score), -who)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                limit = min(bound, math.sqrt(max(own + top - 2 * best[0][0], 0)) + slack)
        else:
            away = np.sqrt(((entries[rows] - lifted_query) ** 2).sum(axis=1))
            low = np.maximum(away - radii[rows], 0)
            for child, least, d in zip(ids[rows].tolist(), low.tolist(), away.tolist()):
                if least <= limit:
                    heapq.heappush(queue, (least, child, d))
    return sorted(((s, -w) for s, w in best), key=lambda x: (-x[0], x[1]))


def _distances(v: np.ndarray, lift: np.ndarray, objects: np.ndarray) -> np.ndarray:
    """From lifted rows (``v`` and the added coordinate) to lifted routing objects."""
    v = np.c_[v, lift]
    square = (v * v).sum(axis=1)[:, None] + (objects * objects).sum(axis=1) - 2.0 * (v @ objects.T)
    return np.sqrt(np.maximum(square, 0.0))


def _by_length(batches, step: int = 2_048):
    """Parts of Arrow batches whose vectors have one length: (dim, part, vectors as doubles)."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            for at in range(0, len(rows), step):
                part = batch.take(pa.array(rows[at : at + step]))
                yield dim, part, part.column("v").flatten().to_numpy().reshape(part.num_rows, dim).astype(float)


def routed(vectors: DataFrame, block_rows: int) -> tuple[DataFrame, dict[int, Routing]]:
    """``vec_id, dim, v, subtree`` of all ``vec_id, dim, v``, and the top level of each length that has one.

    A length of more than ``block_rows`` rows gets four routing objects for each ``block_rows`` of them, at most
    ``MAX_ROUTING``, the first by hash: enough to hit most clusters, as one object over several clusters has a radius
    that spares no query.  They and one summary each are all that the driver sees.  Fewer rows are one subtree.
    """
    square = F.aggregate(F.transform("v", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    sizes = vectors.groupBy("dim").agg(F.count("*").alias("n"), F.max(square).alias("top"))
    large = {r["dim"]: (r["n"], r["top"]) for r in sizes.filter(F.col("n") > block_rows).collect()}
    if not large:
        return vectors.withColumn("subtree", F.lit(0)), {}
    objects = {}
    for dim, (n, top) in large.items():
        key = F.xxhash64("vec_id", F.lit(5))
        drawn = vectors.filter(F.col("dim") == dim).orderBy(key, "vec_id").limit(min(4 * n // block_rows + 1, MAX_ROUTING))
        points = np.unique(np.array([r["v"] for r in drawn.select("v").collect()], float), axis=0)
        objects[dim] = np.c_[points, np.sqrt(np.maximum(top - (points**2).sum(axis=1), 0))], top
    shared = vectors.sparkSession.sparkContext.broadcast(objects)

    def assign(batches):
        for dim, part, v in _by_length(batches):
            near, away = np.zeros(part.num_rows, "int32"), np.zeros(part.num_rows)
            if dim in shared.value:
                points, top = shared.value[dim]
                d = _distances(v, np.sqrt(np.maximum(top - (v * v).sum(axis=1), 0)), points)
                near = d.argmin(axis=1).astype("int32")
                away = d[np.arange(len(d)), near]
            part = part.append_column("subtree", pa.array(near, pa.int32()))
            yield part.append_column("away", pa.array(away))

    table = materialise(vectors.mapInArrow(assign, "vec_id bigint, dim int, v array<bigint>, subtree int, away double"), "routed")
    held = table.filter(F.col("dim").isin(list(large))).groupBy("dim", "subtree").agg(F.count("*").alias("n"), F.max("away").alias("r"))
    routing = {dim: Routing(*objects[dim], np.zeros(len(objects[dim][0]), int), np.zeros(len(objects[dim][0]))) for dim in large}
    for row in held.collect():
        routing[row["dim"]].rows[row["subtree"]], routing[row["dim"]].radius[row["subtree"]] = row["n"], row["r"]
    return table.drop("away"), routing


def index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, dict[int, Routing]]:
    """The tree nodes of all ``vec_id, dim, v`` and the top level; a block holds about ``block_rows`` vectors.

    A subtree of more rows, such as copies of one vector, is dealt into blocks by hash.
    """
    table, routing = routed(vectors, block_rows)
    blocks = table.groupBy("dim", "subtree").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("_blocks"))
    dealt = table.join(blocks, ["dim", "subtree"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), "_blocks").cast("int"))

    def build(key, rows):
        dim, subtree, block = (k.as_py() for k in key)
        ids = rows.column("vec_id").to_numpy()
        points = rows.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
        nodes = build_tree(ids, points)
        kinds = [n[1] for n in nodes]
        return pa.table(
            {
                "dim": pa.array([dim] * len(nodes), pa.int32()),
                "subtree": pa.array([subtree] * len(nodes), pa.int32()),
                "block": pa.array([block] * len(nodes), pa.int32()),
                "node": pa.array([n[0] for n in nodes], pa.int32()),
                "leaf": kinds,
                "ids": pa.array([n[2] for n in nodes], pa.list_(pa.int64())),
                "items": pa.array([n[3].astype("<i8" if n[1] else "<f8").tobytes() for n in nodes], pa.binary()),
                "radius": pa.array([n[4] for n in nodes], pa.list_(pa.float64())),
                "parent": pa.array([n[5] for n in nodes], pa.list_(pa.float64())),
            }
        )

    return dealt.drop("_blocks").groupBy("dim", "subtree", "block").applyInArrow(build, NODE), routing


def visits(queries: DataFrame, routing: dict[int, Routing], k: int, first: bool) -> DataFrame:
    """``vec_id, dim, v, floor, subtree``: the subtrees that a query meets.

    First the nearest ones that together hold more than ``k`` rows; then, with ``floor`` as the score to beat (null:
    any), all others whose covering radius reaches in.  A length without a top level is met whole at first.
    """
    shared = queries.sparkSession.sparkContext.broadcast(routing)

    def reach(batches):
        for dim, part, v in _by_length(batches):
            level = shared.value.get(dim)
            if level is None:
                met = [[0] if first else []] * part.num_rows
            else:
                d = _distances(v, np.zeros(len(v)), level.objects)
                floor = part.column("floor").to_pandas().to_numpy(float)
                own = (v * v).sum(axis=1)
                slack = 1e-6 * np.sqrt(1 + own + level.top)
                limit = np.sqrt(np.maximum(own + level.top - 2 * floor, 0)) + slack
                limit[np.isnan(floor)] = np.inf
                met = []
                for i in range(len(v)):
                    order = np.argsort(d[i], kind="stable")
                    near = order[: int(np.searchsorted(np.cumsum(level.rows[order]), k, side="right")) + 1]
                    if first:
                        met.append(near.tolist())
                        continue
                    wanted = (d[i] - level.radius <= limit[i] + slack[i]) & (level.rows > 0)
                    wanted[near] = False
                    met.append(np.flatnonzero(wanted).tolist())
            yield part.append_column("subtrees", pa.array(met, pa.list_(pa.int32())))

    fields = "vec_id bigint, dim int, v array<bigint>, floor bigint, subtrees array<int>"
    return queries.mapInArrow(reach, fields).withColumn("subtree", F.explode("subtrees")).drop("subtrees")


def _answers(nodes: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the best of each block that a query meets, queries in bounded parts."""
    place = ["dim", "subtree"]
    asked = materialise(asked, "visits")
    parts = asked.groupBy(*place).agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("_parts"))
    parts = materialise(nodes.select(*place, "block").distinct().join(parts, place), "parts")
    trees = nodes.join(parts, [*place, "block"]).withColumn("part", F.explode(F.expr("sequence(0, _parts - 1)"))).drop("_parts")
    asking = asked.join(parts, place).withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(3)), "_parts").cast("int")).drop("_parts")

    def answer(key, tree, asking):
        dim = key[0].as_py()
        out: tuple[list, ...] = ([], [], [])
        if tree.num_rows and asking.num_rows:
            stored, top, large = {}, 0.0, 0
            for row in tree.to_pylist():
                kind, width = ("<i8", dim) if row["leaf"] else ("<f8", dim + 1)
                entries = np.frombuffer(row["items"], kind).reshape(len(row["ids"]), width)
                stored[row["node"]] = (row["leaf"], np.array(row["ids"]), entries, np.array(row["radius"]), np.array(row["parent"]))
                if row["leaf"] and len(entries):
                    top = max(top, float((entries.astype(float) ** 2).sum(axis=1).max()))
                    large = max(large, int(np.abs(entries).max(initial=0)))
            if large < 1 << 52:  # leaf entries as doubles, which hold them exactly
                stored = {n: (leaf, i, e.astype(float) if leaf else e, r, p) for n, (leaf, i, e, r, p) in stored.items()}
            columns = (asking.column(c).to_pylist() for c in ("vec_id", "v", "floor"))
            for who, v, floor in zip(*columns):
                query = np.array(v, np.int64)
                as_double = query.astype(float)
                fits = large * int(np.abs(query).max(initial=0)) * max(dim, 1) < 1 << 52  # exact in doubles
                exact = (lambda e, q: e @ as_double) if fits else (lambda e, q: e.astype(np.int64) @ q)
                for score, other in search(stored, top, who, query, k, exact, floor):
                    for column, x in zip(out, (who, other, score)):
                        column.append(x)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["query_id", "vec_id", "score"])

    key = [*place, "block", "part"]
    return trees.groupBy(*key).cogroup(asking.groupBy(*key)).applyInArrow(
        answer, "query_id bigint, vec_id bigint, score bigint"
    )


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of each row whose id divides by ``every``.

    Ties go to the smaller ``vec_id``; fewer candidates give fewer rows.  A query's own row, and any other row
    of its id, is no candidate of it; repeated queries are answered once.  Vectors of different lengths do not meet.
    Null or non-finite vectors take no part; empty tables give no rows.  Scores must stay below 2^63.
    """
    table = materialise(quantized(vectors, id_col, vec_col), "vectors")
    trees, routing = index(table, block_rows)
    nodes = materialise(trees, "mtree")
    queries = table.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    queries = materialise(queries.withColumn("floor", F.lit(None).cast("bigint")), "queries")
    found = _answers(nodes, visits(queries, routing, k, first=True), k)
    if routing:  # more than one subtree: a score to beat, then what reaches in
        near = materialise(found, "near")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        best = near.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == k)
        beat = best.select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        again = queries.drop("floor").join(beat, "vec_id", "left").select("vec_id", "dim", "v", "floor")
        found = near.unionByName(_answers(nodes, visits(again, routing, k, first=False), k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
