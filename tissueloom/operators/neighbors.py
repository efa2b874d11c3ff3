"""Exact k-nearest-neighbour joins without a cross join.

Base rows are grouped into cells around sampled pivots.  A query visits only the cells that can
hold one of its neighbours (triangle inequality and bisector bounds), and a cell that is large
is split on both sides, so one task compares at most ``block_rows`` x ``block_rows`` vectors and
emits only the k best per query.  Copies of the same vector beyond the k smallest ids can never
be among the k nearest, so a mass of identical vectors is reduced to k rows first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tissueloom.sources.storage import materialise, release

CHUNK_PAIRS = 1_000_000
#: Visits of queries to cells that are shuffled together; more are looked at in turns.
VISIT_ROWS = 20_000_000


def _nearest_in_block(q: np.ndarray, b: np.ndarray, k: int, bound: np.ndarray):
    """Row and column positions and squared distances of the k nearest; ties by column.

    A matrix product in single precision tells how near each pair is; whatever is within its rounding error of
    the k-th (or of ``bound``, a squared distance that a useful neighbour cannot exceed) is recomputed as
    a plain sum of squares before ranking.
    """
    origin = b.mean(axis=0)
    qc, bc = q - origin, b - origin
    qn, bn = (qc * qc).sum(axis=1), (bc * bc).sum(axis=1)
    far = bn.max()
    # with lengths of 1 at most nothing overflows; powers of two cost no digits
    size = 2.0 ** np.ceil(np.log2(max(qn.max(), far) or 1.0) / 2)
    fine = np.float64 if not np.isfinite(size) else np.float32
    if fine is np.float32:
        qc, bc, qn, bn, far = qc / size, bc / size, qn / size / size, bn / size / size, far / size / size
        bound = bound / size / size
    # nearness of a pair: half of what |q|^2 exceeds the squared distance by
    left = np.c_[qc, np.ones(len(q))].astype(fine)
    right = np.c_[bc, -bn / 2].astype(fine)
    off = np.finfo(fine).eps * (q.shape[1] + 8) * (qn + 2 * far) + 1e-37
    k = min(k, len(b))
    sparse = 16 if len(b) >= 64 * k else 1
    step = max(1, CHUNK_PAIRS // len(b))
    for at in range(0, len(q), step):
        part = slice(at, at + step)
        near = left[part] @ right.T
        limit = (qn[part] - bound[part] - off[part]) / 2
        if np.isfinite(bound[part]).all():
            rows, cols = np.nonzero(near >= limit.astype(fine)[:, None])
        else:  # every 16th column tells about how near the k-th is, what is nearer then how near it is
            some = near[:, ::sparse]
            kth = np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k]
            rows, cols = np.nonzero(near >= np.fmax(kth - off[part], limit).astype(fine)[:, None])
            if sparse > 1 and len(rows):
                value = near[rows, cols]
                order = np.lexsort((-value, rows))
                first = np.searchsorted(rows, np.arange(len(near) + 1), side="left")
                least = np.minimum(first[:-1] + k, first[1:]) - 1
                kth = np.where(least - first[:-1] >= k - 1, value[order][np.maximum(least, 0)], -np.inf)
                kept = value >= (kth - off[part])[rows]
                rows, cols = rows[kept], cols[kept]
        if not len(rows):
            continue
        d2 = np.concatenate(
            [
                ((q[at + rows[i : i + 200_000]] - b[cols[i : i + 200_000]]) ** 2).sum(axis=1)
                for i in range(0, len(rows), 200_000)
            ]
        )
        order = np.lexsort((cols, d2, rows))
        rows, cols, d2 = rows[order], cols[order], d2[order]
        first = np.searchsorted(rows, rows, side="left")
        keep = np.arange(len(rows)) - first < k
        yield at + rows[keep], cols[keep], d2[keep]


def _block_join(visits: DataFrame, cells: DataFrame, by: list[str], k: int, carry: list[str], block_rows: int):
    """Local top-k of every (query block, base block) of every visited cell.

    ``_bound`` of a visit (null: unknown) is the squared distance its answers must not exceed.
    """
    at = [*by, "_cell"]
    n_base = cells.groupBy(*at).agg(F.count("*").alias("_nb"))
    n_query = visits.groupBy(*at).agg(F.count("*").alias("_nq"))
    parts = materialise(
        n_base.join(n_query, at).select(
            *at,
            F.ceil(F.col("_nb") / block_rows).cast("int").alias("_bs"),
            F.ceil(F.col("_nq") / block_rows).cast("int").alias("_qs"),
        ),
        "blocks",
    )
    key = [*at, "_qb", "_bb"]
    left = (
        visits.join(parts, at)
        .withColumn("_qb", F.pmod(F.xxhash64("_q"), "_qs").cast("int"))
        .withColumn("_bb", F.explode(F.expr("sequence(0, _bs - 1)")))
        .select(*key, "_q", "_v", "_bound")
    )
    right = (
        cells.join(parts, at)
        .withColumn("_bb", F.pmod(F.xxhash64("_b"), "_bs").cast("int"))
        .withColumn("_qb", F.explode(F.expr("sequence(0, _qs - 1)")))
        .select(*key, "_b", "_v", *carry)
    )
    fields = [left.schema[c] for c in by] + [
        T.StructField("_q", left.schema["_q"].dataType),
        T.StructField("_b", right.schema["_b"].dataType),
        T.StructField("_d2", T.DoubleType()),
        *[right.schema[c] for c in carry],
    ]
    names = [f.name for f in fields]

    def nearest(lf: pd.DataFrame, rt: pd.DataFrame) -> pd.DataFrame:
        if lf.empty or rt.empty:
            return pd.DataFrame({n: [] for n in names})
        rt = rt.sort_values("_b", ignore_index=True)
        q, b = np.stack(lf["_v"].to_numpy()), np.stack(rt["_v"].to_numpy())
        bound = lf["_bound"].to_numpy(float)
        hits = list(_nearest_in_block(q, b, k, np.where(np.isnan(bound), np.inf, bound)))
        if not hits:
            return pd.DataFrame({n: [] for n in names})
        rows, cols, d2 = (np.concatenate([h[i] for h in hits]) for i in range(3))
        out = {c: lf[c].iloc[0] for c in by}
        out |= {"_q": lf["_q"].to_numpy()[rows], "_b": rt["_b"].to_numpy()[cols], "_d2": d2}
        out |= {c: rt[c].to_numpy()[cols] for c in carry}
        return pd.DataFrame(out, columns=names)

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        nearest, T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    )


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by, "_q").orderBy("_d2", "_b")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    # centred on the pivots, which keeps the rounding error of the product small
    mid = pivots.mean(axis=0)
    v, p = v - mid, pivots - mid
    sq = (v * v).sum(axis=1)[:, None] + (p * p).sum(axis=1)[None, :] - 2.0 * (v @ p.T)
    return np.sqrt(np.maximum(sq, 0.0))


def _chunks(frames: Iterator[pd.DataFrame], width: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches cut so that rows x ``width`` stays small, with their stacked vectors."""
    step = max(1, CHUNK_PAIRS // width)
    for pdf in frames:
        for at in range(0, len(pdf), step):
            part = pdf.iloc[at : at + step]
            yield part, np.stack(part["_v"].to_numpy())


def _assign(base: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot's number and the distance to it."""
    schema = T.StructType(
        base.schema.fields + [T.StructField("_cell", T.IntegerType()), T.StructField("_r", T.DoubleType())]
    )
    shared = base.sparkSession.sparkContext.broadcast(pivots)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, v in _chunks(frames, len(shared.value)):
            d = _distances(v, shared.value)
            home = d.argmin(axis=1)
            yield part.assign(_cell=home.astype("int32"), _r=d[np.arange(len(d)), home])

    return base.mapInPandas(assign, schema)


def _visits(queries: DataFrame, shared, by: list[str], k: int, first: bool) -> DataFrame:
    """``_cells`` of each query: those to look into.

    First call: the nearest cells that together hold k rows.  Second call, when ``_bound`` holds
    the squared distance of the k-th row found there: all other cells that can hold a nearer
    one.  A cell's rows are at least (distance to its pivot - its radius) away, and on the other
    side of the bisector between its pivot and the query's nearest pivot.
    """
    schema = T.StructType(queries.schema.fields + [T.StructField("_cells", T.ArrayType(T.IntegerType()))])

    def nearest_cells(d, n):
        order = np.argsort(d, kind="stable")
        return order[: int(np.searchsorted(np.cumsum(n[order]), k)) + 1]

    def visits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots, stats = shared.value
        nothing = (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        for part, v in _chunks(frames, len(pivots)):
            d = _distances(v, pivots)
            eps = 1e-6 * (1.0 + d.max())  # covers the rounding error of the distance product
            groups = [tuple(g) for g in part[by].to_numpy(object)] if by else [()] * len(part)
            cells = []
            if first:
                for i, g in enumerate(groups):
                    live, n, _ = stats.get(g, nothing)
                    cells.append(live[nearest_cells(d[i, live], n)].tolist())
            else:
                home = d.argmin(axis=1)
                between = _distances(pivots[home], pivots)
                reach = np.sqrt(part["_bound"].fillna(np.inf).to_numpy(float)) + eps
                for i, g in enumerate(groups):
                    live, n, r = stats.get(g, nothing)
                    di, gap = d[i, live], between[i, live]
                    side = np.zeros(len(live))
                    apart = gap > eps
                    side[apart] = (di[apart] ** 2 - d[i, home[i]] ** 2) / (2 * gap[apart])
                    wanted = np.maximum(di - r, side) <= reach[i]
                    wanted[nearest_cells(di, n)] = False
                    cells.append(live[wanted].tolist())
            yield part.assign(_cells=cells)

    return queries.mapInPandas(visits, schema)


def knn_join(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    by: Sequence[str] = (),
    query_id: str = "cell",
    base_id: str = "cell",
    vec: str = "vec",
    carry: Sequence[str] = (),
    exclude_self: bool = False,
    block_rows: int = 20_000,
    max_pivots: int = 16_384,
    max_cells: int = 500_000,
) -> DataFrame:
    """The k nearest base rows of each query row, by (Euclidean distance, base id).

    ``by`` restricts neighbours to the same group.  Returns ``by…, src, dst, rank, d2, carry…``.
    What reaches the driver is bounded by parameters: at most ``max_pivots`` pivots and
    ``max_cells`` cell summaries.
    """
    by, carry = list(by), list(carry)
    spark = base.sparkSession
    want = k + 1 if exclude_self else k
    as_vec = F.col(vec).cast("array<double>").alias("_v")
    # everything starts in one cell; as a written column it stays an ordinary join key
    one = F.lit(0).alias("_cell")
    q = materialise(queries.select(*by, F.col(query_id).alias("_q"), as_vec, one), "queries")
    b = materialise(base.select(*by, F.col(base_id).alias("_b"), as_vec, *carry, one), "base")

    copies = b.groupBy(*by, F.xxhash64("_v").alias("_h")).agg(F.count("*").alias("_n"))
    size = (
        copies.groupBy(*by)
        .agg(F.max("_n").alias("copies"), F.sum("_n").alias("rows"))
        .agg(F.max("copies").alias("copies"), F.max("rows").alias("rows"), F.count("*").alias("groups"))
        .first()
    )
    if (size["copies"] or 0) > max(block_rows // 10, want):
        same = Window.partitionBy(*by, "_v").orderBy("_b")
        b = materialise(
            b.withColumn("_copy", F.row_number().over(same)).filter(F.col("_copy") <= want).drop("_copy"),
            "base",
        )

    n_pivots = 1
    if (size["rows"] or 0) > block_rows:
        n_pivots = min(max_pivots, math.ceil(4 * size["rows"] / block_rows), max_cells // size["groups"])
    no_bound = F.lit(None).cast("double").alias("_bound")
    if n_pivots <= 1:
        found = _block_join(q.select("*", no_bound), b, by, want, carry, block_rows)
        top = _best(found, by, want)
    else:
        q, b = q.drop("_cell"), b.drop("_cell")
        picked = b.select("_v", F.md5(F.col("_b").cast("string")).alias("_key")).orderBy("_key").limit(n_pivots)
        pivots = np.unique(np.stack([np.asarray(r["_v"]) for r in picked.collect()]), axis=0)
        cells = materialise(_assign(b, pivots), "assigned")
        release(b)
        summary = cells.groupBy(*by, "_cell").agg(F.count("*").alias("n"), F.max("_r").alias("r")).toPandas()
        stats = {}
        for g, part in summary.groupby(by) if by else [((), summary)]:
            stats[g if isinstance(g, tuple) else (g,)] = (
                part["_cell"].to_numpy(), part["n"].to_numpy(), part["r"].to_numpy()
            )
        shared = spark.sparkContext.broadcast((pivots, stats))
        cells = cells.drop("_r")

        def look(queries: DataFrame, first: bool) -> DataFrame:
            visits = materialise(_visits(queries, shared, by, want, first), "visits")
            turns = (visits.agg(F.sum(F.size("_cells"))).first()[0] or 0) // VISIT_ROWS + 1
            found = []
            for turn in range(turns):
                asked = visits.filter(F.pmod(F.xxhash64("_q", F.lit(turns)), F.lit(turns)) == turn) if turns > 1 else visits
                part = _block_join(asked.withColumn("_cell", F.explode("_cells")).drop("_cells"), cells, by, want, carry, block_rows)
                found.append(materialise(_best(part, by, want).drop("rank"), "found") if turns > 1 else part)
            return reduce(DataFrame.unionByName, found)

        near = materialise(_best(look(q.select("*", no_bound), True), by, want).drop("rank"), "near")
        kth = near.groupBy(*by, "_q").agg(F.when(F.count("*") >= want, F.max("_d2")).alias("_bound"))
        far = look(q.join(kth, [*by, "_q"], "left").select(*by, "_q", "_v", "_bound"), False)
        top = _best(near.unionByName(far), by, want)
    if exclude_self:
        top = _best(top.filter(F.col("_q") != F.col("_b")).drop("rank"), by, k)
    return top.select(
        *by, F.col("_q").alias("src"), F.col("_b").alias("dst"), "rank", F.col("_d2").alias("d2"), *carry
    )


def knn_graph(
    cells: DataFrame,
    e_neigh: int = 30,
    s_neigh: int = 6,
    pca: str = "vec",
    space: str = "xyz",
    approximate: bool = False,
    **sizes,
) -> DataFrame:
    """Directed neighbours in expression space and in physical space: ``src, dst, kind, rank``.

    ``approximate``: those in expression space come from ``descent_graph``, for cells so many that comparing nearly
    all pairs of long vectors is out of reach; the cells' ids must be whole numbers.
    """
    from tissueloom.operators.descent import descent_graph

    if approximate:
        near = descent_graph(cells, e_neigh, vec=pca).graph
    else:
        near = knn_join(cells, cells, e_neigh, vec=pca, exclude_self=True, **sizes)
    around = knn_join(cells, cells, s_neigh, vec=space, exclude_self=True, **sizes)
    as_kind = lambda found, kind: found.select("src", "dst", F.lit(kind).alias("kind"), "rank")
    return as_kind(near, "expression").unionByName(as_kind(around, "space"))


def symmetric_edges(graph: DataFrame) -> DataFrame:
    """Both directions of every neighbour pair once, with weight 1."""
    both = F.array(
        F.struct(F.col("src").alias("i"), F.col("dst").alias("j")),
        F.struct(F.col("dst").alias("i"), F.col("src").alias("j")),
    )
    return graph.select(F.inline(both)).distinct().withColumn("w", F.lit(1.0))
