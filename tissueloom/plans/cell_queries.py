"""Queries on vectors: neighbours, lineage, markers, annotation, registration, clustering."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tissueloom.operators import align, annotate, communities, descent, grid, leiden, lineage, longpca, markers, neighbors, normalize, qc, reduce, soft
from tissueloom.plans import bindings as bind
from tissueloom.plans.bindings import with_ctes
from tissueloom.plans.registry import QUERIES, query, rd
from tissueloom.plans.spot_queries import RESID_SQL
from tissueloom.sources import tables
from tissueloom.sources.storage import fresh_path, materialise

REPLICATES = lineage.REPLICATES
SEED = 7


def r6(df, *cols, digits=6):
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c), digits))
    return df


# --- lineage ---------------------------------------------------------------------------------


@query("assay_subset", with_ctes("SELECT cell_id, assay, stage, state FROM sc_cells WHERE assay = 'RNA'", "sc_cells"))
def assay_subset(spark, sf_dir):
    return lineage.assay_subset(bind.sc_cells(spark, sf_dir), "RNA").drop("emb")


_PAIRS = {
    "pairs": """SELECT DISTINCT a.assay, a.stage AS pre_stage, b.stage AS nex_stage FROM
      (SELECT DISTINCT assay, stage FROM sc_cells) a JOIN (SELECT DISTINCT assay, stage FROM sc_cells) b
      ON a.assay = b.assay AND a.stage < b.stage""",
}


@query("time_pairs", with_ctes("SELECT * FROM pairs", "sc_cells", extra=_PAIRS))
def time_pairs(spark, sf_dir):
    return lineage.time_pairs(bind.sc_cells(spark, sf_dir))


@query(
    "emb_align_check",
    with_ctes(
        """SELECT count(m) AS n_meta, count(*) AS n_emb, count(*) - count(m) AS missing_meta, 0 AS missing_emb
           FROM (SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN 1 END AS m FROM embeddings)"""
    ),
)
def emb_align_check(spark, sf_dir):
    cells = bind.sc_cells(spark, sf_dir)
    return lineage.check_alignment(lineage.assay_subset(cells, "RNA"), cells)


_SAMPLE = {
    "sample": f"""SELECT * EXCLUDE (rn, n) FROM (
        SELECT *, row_number() OVER (PARTITION BY assay, stage, state ORDER BY md5(concat_ws('|', cell_id, {SEED}))) AS rn,
          count(*) OVER (PARTITION BY assay, stage, state) AS n FROM sc_cells)
      WHERE rn <= (n + 4) // 5"""
}


@query("stratified_sample", with_ctes("SELECT cell_id, assay, stage, state FROM sample", "sc_cells", extra=_SAMPLE))
def stratified_sample(spark, sf_dir):
    return lineage.stratified_sample(bind.sc_cells(spark, sf_dir), seed=SEED).drop("emb")


_KEY = "assay, pre_stage, nex_stage"
def _lineage_sql(replicates: int) -> dict[str, str]:
    return _PAIRS | {
        "sides": f"""SELECT {_KEY}, 'pre' AS day, cell_id, state, emb FROM pairs JOIN sc_cells s USING (assay) WHERE s.stage = pre_stage
          UNION ALL SELECT {_KEY}, 'nex', cell_id, state, emb FROM pairs JOIN sc_cells s USING (assay) WHERE s.stage = nex_stage""",
        "pool": f"""SELECT * EXCLUDE (rn, n) FROM (SELECT *, count(*) OVER (PARTITION BY {_KEY}, day, state) AS n,
            row_number() OVER (PARTITION BY {_KEY}, day, state
              ORDER BY md5(concat_ws('|', cell_id, pre_stage, nex_stage, {SEED}))) AS rn FROM sides)
          WHERE rn <= (n + 4) // 5""",
        "drawn": f"""SELECT * FROM (SELECT p.*, rep, row_number() OVER (PARTITION BY {_KEY}, rep
            ORDER BY md5(concat_ws('|', cell_id, rep, {SEED}))) AS pos, count(*) OVER (PARTITION BY {_KEY}, rep) AS n
          FROM pool p, (SELECT unnest(range(1, {2 * replicates} + 1)) AS rep)) WHERE pos <= round(n * 0.8::DOUBLE)""",
        "state_n": f"SELECT {_KEY}, rep, state, count(*) AS n FROM drawn WHERE day = 'pre' GROUP BY ALL",
        "reps": f"""SELECT *, CAST(least(5, min(smallest) OVER (PARTITION BY {_KEY} ORDER BY rep)) AS INTEGER) AS k FROM (
            SELECT {_KEY}, rep, min(n) AS smallest, row_number() OVER (PARTITION BY {_KEY} ORDER BY rep) AS idx
            FROM state_n GROUP BY {_KEY}, rep HAVING min(n) >= 3) WHERE idx <= {replicates}""",
        "near": f"""SELECT {_KEY}, rep, nex_state, pre_state FROM (
            SELECT q.assay, q.pre_stage, q.nex_stage, q.rep, q.state AS nex_state, b.state AS pre_state, r.k,
              row_number() OVER (PARTITION BY q.assay, q.pre_stage, q.nex_stage, q.rep, q.cell_id
                ORDER BY list_distance(q.emb, b.emb), b.cell_id) AS rn
            FROM drawn q JOIN reps r USING ({_KEY}, rep) JOIN drawn b USING ({_KEY}, rep)
            WHERE q.day = 'nex' AND b.day = 'pre') WHERE rn <= k""",
        "cnts": f"SELECT {_KEY}, rep, nex_state, pre_state, count(*) AS n FROM near GROUP BY ALL",
        "probs": f"""SELECT {_KEY}, rep, nex_state, s.state AS pre_state, coalesce(c.n, 0) AS n,
            coalesce(c.n, 0) / total AS prob
          FROM (SELECT {_KEY}, rep, nex_state, sum(n)::DOUBLE AS total FROM cnts GROUP BY ALL) t
          JOIN state_n s USING ({_KEY}, rep)
          LEFT JOIN (SELECT {_KEY}, rep, nex_state, pre_state AS state, n FROM cnts) c USING ({_KEY}, rep, nex_state, state)""",
        "med": f"SELECT {_KEY}, nex_state, pre_state, median(prob) AS prob FROM probs GROUP BY ALL",
        "edges": """SELECT assay, pre_stage || ':' || pre_state AS parent, nex_stage || ':' || nex_state AS child, prob
          FROM med WHERE round(prob, 12) >= 0.2::DOUBLE""",
    }


_LINEAGE = _lineage_sql(REPLICATES)


def _prepared(spark, sf_dir):
    return tuple(materialise(t, "pool") for t in lineage.pair_samples(bind.sc_cells(spark, sf_dir), seed=SEED))


def _transitions(spark, sf_dir, replicates=REPLICATES):
    return lineage.lineage_transitions(bind.sc_cells(spark, sf_dir), replicates=replicates, seed=SEED)


@query("lineage_reps", with_ctes(f"SELECT {_KEY}, rep, smallest, k FROM reps", "sc_cells", extra=_LINEAGE))
def lineage_reps(spark, sf_dir):
    reps, _ = lineage.lineage_reps(*_prepared(spark, sf_dir), replicates=REPLICATES, seed=SEED)
    return reps.select(*lineage.PAIR, "rep", "smallest", "k")


@query(
    "lineage_prospects",
    with_ctes(
        f"""SELECT {_KEY}, n, take, EXISTS (SELECT 1 FROM ranked r WHERE r.assay = t.assay AND r.pre_stage = t.pre_stage
              AND r.nex_stage = t.nex_stage AND take BETWEEN 3 * i AND most + later) AS possible FROM totals t""",
        "sc_cells",
        extra=_LINEAGE | {
            "sizes": f"SELECT {_KEY}, day, state, count(*) AS size FROM pool GROUP BY ALL",
            "totals": f"""SELECT {_KEY}, sum(size)::BIGINT AS n, CAST(round(sum(size) * 0.8::DOUBLE) AS BIGINT) AS take,
                sum(size) FILTER (day = 'nex') AS later FROM sizes GROUP BY ALL""",
            "ranked": f"""SELECT {_KEY}, row_number() OVER w AS i, sum(size) OVER w AS most FROM sizes
              WHERE day = 'pre' AND size >= 3 WINDOW w AS (PARTITION BY {_KEY} ORDER BY size DESC, state)""",
        },
    ),
)
def lineage_prospects(spark, sf_dir):
    return lineage.pair_prospects(*_prepared(spark, sf_dir))


@query("lineage_counts", with_ctes("SELECT * FROM cnts", "sc_cells", extra=_LINEAGE))
def lineage_counts(spark, sf_dir):
    pre, nex = _prepared(spark, sf_dir)
    reps, _ = lineage.lineage_reps(pre, nex, replicates=REPLICATES, seed=SEED)
    return lineage.lineage_counts(pre, nex, reps, seed=SEED)


@query("lineage_probs", with_ctes("SELECT * FROM probs", "sc_cells", extra=_LINEAGE))
def lineage_probs(spark, sf_dir):
    return _transitions(spark, sf_dir)


@query("lineage_median", with_ctes("SELECT * REPLACE (round(prob, 6) AS prob) FROM med", "sc_cells", extra=_LINEAGE))
def lineage_median(spark, sf_dir):
    return r6(lineage.lineage_median(_transitions(spark, sf_dir)), "prob")


@query(
    "pair_samples",
    with_ctes(f"SELECT {_KEY}, day, cell_id, state FROM pool", "sc_cells", extra=_LINEAGE),
)
def pair_samples(spark, sf_dir):
    pre, nex = lineage.pair_samples(bind.sc_cells(spark, sf_dir), seed=SEED)
    side = lambda df, day: df.select(*lineage.PAIR, F.lit(day).alias("day"), "cell_id", "state")
    return side(pre, "pre").unionByName(side(nex, "nex"))


@query(
    "lineage_files",
    with_ctes(
        f"""SELECT {_KEY}, nex_state, pre_state, round(median(prob), 6) AS prob, count(*) AS replicates, sum(n) AS links
            FROM probs GROUP BY ALL""",
        "sc_cells",
        extra=_LINEAGE,
    ),
)
def lineage_files(spark, sf_dir):
    """All replicates and the medians, written by time pair and read back."""
    entries, path = materialise(_transitions(spark, sf_dir), "transitions"), fresh_path(spark, "lineage")
    tables.write_lineage(entries, lineage.lineage_median(entries), path)
    key = [*lineage.PAIR, "nex_state", "pre_state"]
    fields = "assay string, pre_stage int, nex_stage int, nex_state string, pre_state string"
    replicates = tables.scan_lineage(spark, path, "replicates", f"{fields}, rep int, n bigint, prob double")
    median = tables.scan_lineage(spark, path, "median", f"{fields}, prob double")
    counted = replicates.groupBy(*key).agg(F.count("*").alias("replicates"), F.sum("n").alias("links"))
    return r6(median.join(counted, key), "prob")


@query(
    "lineage_wide",
    with_ctes(
        f"""SELECT {_KEY}, nex_state, round(max(prob) FILTER (pre_state = 's0'), 6) AS s0,
              round(max(prob) FILTER (pre_state = 's1'), 6) AS s1, round(max(prob) FILTER (pre_state = 's2'), 6) AS s2
            FROM med GROUP BY ALL""",
        "sc_cells", extra=_LINEAGE,
    ),
)
def lineage_wide(spark, sf_dir):
    median = lineage.lineage_median(_transitions(spark, sf_dir))
    return r6(lineage.lineage_wide(median, ["s0", "s1", "s2"]), "s0", "s1", "s2")


@query("lineage_edges", with_ctes("SELECT * REPLACE (round(prob, 6) AS prob) FROM edges", "sc_cells", extra=_LINEAGE))
def lineage_edges(spark, sf_dir):
    return r6(lineage.lineage_edges(lineage.lineage_median(_transitions(spark, sf_dir))), "prob")


@query(
    "lineage_ancestor",
    with_ctes(
        """SELECT assay, child, parent, round(prob, 6) AS prob FROM (SELECT *, row_number() OVER (PARTITION BY assay, child
             ORDER BY round(prob, 12) DESC, parent) AS rn FROM edges) WHERE rn = 1""",
        "sc_cells", extra=_LINEAGE,
    ),
)
def lineage_ancestor(spark, sf_dir):
    edges = lineage.lineage_edges(lineage.lineage_median(_transitions(spark, sf_dir)))
    return r6(lineage.lineage_ancestor(edges), "prob")


@query(
    "lineage_sweep",
    with_ctes("SELECT * REPLACE (round(prob, 6) AS prob) FROM med", "sc_cells", extra=_lineage_sql(lineage.REPLICATES)),
)
def lineage_sweep(spark, sf_dir):
    """Every pair of every assay with the full number of replicates, kept apart by state."""
    return r6(lineage.lineage_median(_transitions(spark, sf_dir, lineage.REPLICATES)), "prob")


@query(
    "lineage_paths",
    with_ctes(
        """SELECT src, dst, round(prob, 9) AS prob, steps, array_to_string(path, '>') AS path FROM (
             SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY round(prob, 12) DESC, steps, path) AS rn FROM walk)
           WHERE rn = 1""",
        "line_chain",
        extra={
            "walk": """SELECT parent AS src, child AS dst, prob, 1 AS steps, [parent, child] AS path FROM line_chain
              UNION ALL SELECT w.src, e.child, w.prob * e.prob, w.steps + 1, list_append(w.path, e.child)
              FROM walk w JOIN line_chain e ON w.dst = e.parent"""
        },
        recursive=True,
    ),
)
def lineage_paths(spark, sf_dir):
    found = lineage.lineage_paths(bind.line_chain(spark, sf_dir))
    return r6(found.withColumn("path", F.array_join("path", ">")), "prob", digits=9)


# --- neighbours and communities --------------------------------------------------------------


@query(
    "knn_join",
    with_ctes(
        f"""SELECT {_KEY}, src, dst, rank, round(d * d, 6) AS d2 FROM (
             SELECT {_KEY}, q.cell_id AS src, b.cell_id AS dst, list_distance(q.emb, b.emb) AS d,
               row_number() OVER (PARTITION BY {_KEY}, q.cell_id ORDER BY list_distance(q.emb, b.emb), b.cell_id) AS rank
             FROM pairs JOIN sc_cells q USING (assay) JOIN sc_cells b USING (assay)
             WHERE q.stage = nex_stage AND b.stage = pre_stage) WHERE rank <= 5""",
        "sc_cells", extra=_PAIRS,
    ),
)
def knn_join(spark, sf_dir):
    pre, nex = lineage.pair_pool(bind.sc_cells(spark, sf_dir))
    near = neighbors.knn_join(nex, pre, 5, by=lineage.PAIR, query_id="cell_id", base_id="cell_id", vec="emb")
    return r6(near, "d2")


_GRAPH = {
    "graph": " UNION ALL ".join(
        f"""SELECT src, dst, '{kind}' AS kind, rank FROM (SELECT a.cell AS src, b.cell AS dst,
              row_number() OVER (PARTITION BY a.cell ORDER BY list_distance(a.{v}, b.{v}), b.cell) AS rank
            FROM vecs a JOIN vecs b ON a.cell <> b.cell) WHERE rank <= {n}"""
        for kind, v, n in (("expression", "vec", 30), ("space", "xyz", 6))
    ),
    "sym": "SELECT src AS i, dst AS j FROM graph UNION SELECT dst, src FROM graph",
}


@query("knn_graph", with_ctes("SELECT src, dst, kind, rank FROM graph", "vecs", extra=_GRAPH))
def knn_graph(spark, sf_dir):
    return neighbors.knn_graph(bind.vecs(spark, sf_dir))


@query("knn_edges", with_ctes("SELECT i, j, 1.0::DOUBLE AS w FROM sym", "vecs", extra=_GRAPH))
def knn_edges(spark, sf_dir):
    return neighbors.symmetric_edges(neighbors.knn_graph(bind.vecs(spark, sf_dir)))


@query(
    "space_neighbors",
    with_ctes(
        """SELECT src, dst, rank, round(d * d, 6) AS d2 FROM (
             SELECT a.cell AS src, b.cell AS dst, list_distance(a.xyz, b.xyz) AS d,
               row_number() OVER (PARTITION BY a.cell ORDER BY list_distance(a.xyz, b.xyz), b.cell) AS rank
             FROM vecs a JOIN vecs b ON a.cell <> b.cell) WHERE rank <= 6""",
        "vecs",
    ),
)
def space_neighbors(spark, sf_dir):
    return r6(grid.grid_knn(bind.vecs(spark, sf_dir), 6), "d2")


@query(
    "cell_neighbors",
    with_ctes(
        """SELECT slice, src, dst, rank, round(d2, 6) AS d2 FROM (
             SELECT a.slice, a.cell AS src, b.cell AS dst, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 AS d2,
               row_number() OVER (PARTITION BY a.slice, a.cell ORDER BY (a.x - b.x) ** 2 + (a.y - b.y) ** 2, b.cell) AS rank
             FROM cells a JOIN cells b ON a.slice = b.slice AND a.cell <> b.cell) WHERE rank <= 6""",
        "cells",
    ),
)
def cell_neighbors(spark, sf_dir):
    """Cells on a regular raster: most distances are tied."""
    cells = bind.cells(spark, sf_dir).select("slice", "cell", F.array("x", "y").alias("xyz"))
    return r6(grid.grid_knn(cells, 6, by=["slice"]), "d2")


@query("descent_recall")
def descent_recall(spark, sf_dir):
    """How many of the exact neighbours the descent finds, and for what share of all pairs compared."""
    cells = materialise(bind.order_profiles(spark, sf_dir), "profiles")
    return descent.descent_recall(descent.descent_graph(cells, 15), cells)


@query(
    "descent_checks",
    """SELECT count(DISTINCT l_orderkey) AS nodes, 15 * count(DISTINCT l_orderkey) AS entries, 0 AS short, 0 AS loops,
         0 AS repeated, 0 AS unsorted, 0 AS wrong, true AS recall_reached, true AS tenth_compared FROM lineitem""",
)
def descent_checks(spark, sf_dir):
    """What must hold of approximate lists: full, free of loops and repeats, in order, with true distances; recall of
    at least 0.95 for at most a tenth of all pairs compared."""
    cells = materialise(bind.order_profiles(spark, sf_dir), "profiles")
    found = descent.descent_graph(cells, 15)
    vec = lambda side: cells.select(F.col("cell").alias(side), F.col("vec").alias(f"_{side}"))
    real = F.aggregate(F.zip_with("_src", "_dst", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    off = F.when(F.abs(real - F.col("d2")) > 1e-6, 1).otherwise(0)
    ends = found.graph.select("src", "dst", "d2").join(vec("src"), "src").join(vec("dst"), "dst")
    wrong = materialise(ends.agg(F.sum(off).alias("wrong")), "wrong").first()["wrong"]
    order = Window.partitionBy("src").orderBy("rank")
    rows = found.graph.withColumn("_before", F.lag(F.struct("d2", "dst")).over(order))
    lists = rows.groupBy("src").agg(
        F.count("*").alias("n"), F.countDistinct("dst").alias("different"),
        F.count_if(F.col("src") == F.col("dst")).alias("loops"),
        F.count_if(F.col("_before") > F.struct("d2", "dst")).alias("unsorted"),
    )
    total = lists.agg(
        F.count("*").alias("nodes"), F.sum("n").alias("entries"), F.count_if(F.col("n") < 15).alias("short"),
        F.sum("loops").alias("loops"), F.sum(F.col("n") - F.col("different")).alias("repeated"),
        F.sum("unsorted").alias("unsorted"),
    )
    total = materialise(total, "totals")
    quality = descent.descent_recall(found, cells).first()
    return total.select(
        "*",
        F.lit(wrong).cast("bigint").alias("wrong"),
        F.lit(quality["recall"] >= 0.95).alias("recall_reached"),
        F.lit(quality["compared_share"] <= 0.1).alias("tenth_compared"),
    )


def _rounds(n: int) -> dict[str, str]:
    parts = dict(_GRAPH)
    parts["deg"] = "SELECT i, count(*)::DOUBLE AS k FROM sym GROUP BY i"
    parts["tot"] = "SELECT sum(k) AS m2 FROM deg"
    parts["c0"] = "SELECT r AS resolution, i, i AS c, k FROM deg, (SELECT unnest([1.2::DOUBLE, 2.2::DOUBLE]) AS r)"
    for t in range(n):
        parts[f"o{t}"] = f"""SELECT e.resolution, e.i, e.c, max(e.kic) AS kic, any_value(kk.kc) AS kc, any_value(me.k) AS k, any_value(me.c) AS own
          FROM (SELECT n.resolution, s.i, n.c, count(*)::DOUBLE AS kic FROM sym s JOIN c{t} n ON n.i = s.j GROUP BY ALL
                UNION ALL SELECT resolution, i, c, 0 FROM c{t}) e
          JOIN (SELECT resolution, c, sum(k) AS kc FROM c{t} GROUP BY ALL) kk ON kk.resolution = e.resolution AND kk.c = e.c
          JOIN c{t} me ON me.resolution = e.resolution AND me.i = e.i GROUP BY e.resolution, e.i, e.c"""
        parts[f"g{t}"] = f"""SELECT *, round(kic - resolution * k * (kc - CASE WHEN c = own THEN k ELSE 0 END) / m2, 9) AS gain
          FROM o{t}, tot"""
        parts[f"c{t + 1}"] = f"""SELECT resolution, i, CASE WHEN i % 2 = {t % 2} AND best > stay THEN bc ELSE own END AS c, k FROM (
            SELECT resolution, i, any_value(k) AS k, any_value(own) AS own, max(gain) AS best,
              arg_min(c, (-gain, c)) AS bc, max(gain) FILTER (c = own) AS stay FROM g{t} GROUP BY resolution, i)"""
    parts["sizes"] = f"""SELECT resolution, c, row_number() OVER (PARTITION BY resolution ORDER BY count(*) DESC, min(i)) - 1 AS community
      FROM c{n} GROUP BY resolution, c"""
    return parts


@query(
    "communities",
    with_ctes(
        "SELECT resolution, i AS node, community FROM c2 JOIN sizes USING (resolution, c)", "vecs", extra=_rounds(2)
    ),
)
def community_rounds(spark, sf_dir):
    edges = neighbors.symmetric_edges(neighbors.knn_graph(bind.vecs(spark, sf_dir)))
    return communities.communities(edges, (1.2, 2.2), rounds=2, levels=1)


@query("community_sweep")
def community_sweep(spark, sf_dir):
    """All six resolutions until no move gains."""
    edges = neighbors.symmetric_edges(neighbors.knn_graph(bind.vecs(spark, sf_dir)))
    return leiden.refined_communities(edges)


@query(
    "community_checks",
    """SELECT 1.2::DOUBLE AS resolution, count(*) AS nodes, 0 AS unconnected, 0 AS gaining, true AS above_labels
       FROM embeddings""",
)
def community_checks(spark, sf_dir):
    """What must hold of communities: all nodes, each connected, no single move gains, above the planted labels."""
    edges = materialise(neighbors.symmetric_edges(neighbors.knn_graph(bind.vecs(spark, sf_dir))), "graph")
    return leiden.checks(edges, leiden.refined_communities(edges, (1.2,)), bind.groups(spark, sf_dir))


@query(
    "community_planted",
    """WITH sizes AS (SELECT vec_id // 8 AS g, row_number() OVER (ORDER BY count(*) DESC, min(vec_id)) - 1 AS community
         FROM embeddings GROUP BY 1)
       SELECT resolution, vec_id AS node, community FROM embeddings JOIN sizes ON vec_id // 8 = g,
         (SELECT unnest([1.2::DOUBLE, 1.4::DOUBLE, 1.6::DOUBLE, 1.8::DOUBLE, 2.0::DOUBLE, 2.2::DOUBLE]) AS resolution)""",
)
def community_planted(spark, sf_dir):
    """Groups of eight cells, all linked, in a ring of faint links: every resolution finds the groups."""
    cells = bind.vecs(spark, sf_dir).select(F.col("cell").alias("i"), F.expr("cell div 8").alias("g"))
    others = cells.select(F.col("i").alias("j"), "g")
    inner = cells.join(others, "g").filter("i <> j").select("i", "j", F.lit(1.0).alias("w"))
    ring = cells.filter("i % 8 = 0 AND i > 0").select("i", (F.col("i") - 1).alias("j"), F.lit(1e-4).alias("w"))
    return leiden.refined_communities(inner.unionByName(ring).unionByName(ring.select(F.col("j").alias("i"), F.col("i").alias("j"), "w")))


# --- markers ---------------------------------------------------------------------------------

_WELCH = {
    "gs": """SELECT label AS "group", gene, count(*)::DOUBLE AS n1, sum(value) AS s1, sum(value * value) AS s2
      FROM vals GROUP BY ALL""",
    "rest": """SELECT *, sum(n1) OVER g - n1 AS n2, sum(s1) OVER g - s1 AS r1, sum(s2) OVER g - s2 AS r2
      FROM gs WINDOW g AS (PARTITION BY gene)""",
    "mom": """SELECT *, s1 / n1 AS m1, r1 / n2 AS m2, greatest((s2 - n1 * (s1 / n1) ** 2) / (n1 - 1), 0) / n1 AS e1,
        greatest((r2 - n2 * (r1 / n2) ** 2) / (n2 - 1), 0) / n2 AS e2 FROM rest""",
    "tests": """SELECT *, (m1 - m2) / sqrt(e1 + e2) AS score, (exp(m1) - 1 + 1e-9) / (exp(m2) - 1 + 1e-9) AS ratio,
        (e1 + e2) ** 2 / (e1 ** 2 / (n1 - 1) + e2 ** 2 / (n2 - 1)) AS df FROM mom""",
    "ranked": """SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY score DESC, gene) AS rank FROM tests""",
    # two-sided Student tail: t = sqrt(df) tan(a), Simpson's rule over a
    "pvals": """SELECT "group", gene, any_value(p0 * h / 3) * sum(wt * exp((df - 1) * ln(cos(lo + i * h)))) AS pval FROM (
        SELECT "group", gene, df, lo, (pi() / 2 - lo) / 2000 AS h,
          2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi()) AS p0, i,
          CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS wt
        FROM (SELECT "group", gene, df, atan(abs(score) / sqrt(df)) AS lo, unnest(range(0, 2000)) AS i FROM tests))
      GROUP BY "group", gene""",
    "adj": """SELECT "group", gene, pval, least(min(raw) OVER (PARTITION BY "group" ORDER BY pval DESC, gene DESC), 1) AS padj
      FROM (SELECT *, pval * count(*) OVER (PARTITION BY "group") / row_number() OVER (PARTITION BY "group" ORDER BY pval, gene) AS raw
            FROM pvals)""",
}


@query(
    "rank_markers",
    with_ctes(
        f"""SELECT "group", gene, rank, {rd('score')} AS score, CASE WHEN ratio > 0 THEN {rd('log2(ratio)')} END AS logfc,
              round(df, 6) AS df FROM ranked WHERE rank <= 50""",
        "vals", extra=_WELCH,
    ),
)
def rank_markers(spark, sf_dir):
    top = markers.rank_markers(bind.values(spark, sf_dir), bind.groups(spark, sf_dir))
    return r6(top.select("group", "gene", "rank", "score", "logfc", "df"), "score", "logfc", "df")


@query(
    "marker_pvalues",
    with_ctes('SELECT "group", gene, round(pval, 6) AS pval, round(padj, 6) AS padj FROM adj', "vals", extra=_WELCH),
)
def marker_pvalues(spark, sf_dir):
    tested = markers.welch_table(bind.values(spark, sf_dir), bind.groups(spark, sf_dir))
    return r6(tested.select("group", "gene", "pval", "padj"), "pval", "padj")


@query("marker_set", with_ctes("SELECT DISTINCT gene FROM ranked WHERE rank <= 20", "vals", extra=_WELCH))
def marker_set(spark, sf_dir):
    return markers.marker_set(markers.rank_markers(bind.values(spark, sf_dir), bind.groups(spark, sf_dir)))


_SWEEP = {
    key: sql.replace('"group"', 'resolution, "group"').replace("PARTITION BY gene", "PARTITION BY resolution, gene")
    for key, sql in _WELCH.items()
    if key in ("rest", "mom", "tests", "ranked")
} | {
    "gs": """SELECT resolution, "group", gene, count(*)::DOUBLE AS n1, sum(value) AS s1, sum(value * value) AS s2
      FROM vals JOIN clusters USING (cell) GROUP BY ALL"""
}
_SWEEP = {k: _SWEEP[k] for k in ("gs", "rest", "mom", "tests", "ranked")}


@query("marker_union", with_ctes("SELECT DISTINCT gene FROM ranked WHERE rank <= 20", "vals", "clusters", extra=_SWEEP))
def marker_union(spark, sf_dir):
    top = markers.rank_markers(bind.values(spark, sf_dir), bind.clusters(spark, sf_dir), by=["resolution"])
    return markers.marker_set(top)


@query(
    "marker_sweep",
    with_ctes(
        f"""SELECT resolution, "group", gene, rank, {rd('score')} AS score FROM ranked WHERE rank <= 50""",
        "vals", "clusters", extra=_SWEEP,
    ),
)
def marker_sweep(spark, sf_dir):
    top = markers.rank_markers(bind.values(spark, sf_dir), bind.clusters(spark, sf_dir), by=["resolution"])
    return r6(top.select("resolution", "group", "gene", "rank", "score"), "score")


@query(
    "heatmap_table",
    with_ctes(
        """SELECT "group", gene, round(least(greatest(s1 / n1, 0.3::DOUBLE), 3), 6) AS value
           FROM gs SEMI JOIN (SELECT DISTINCT gene FROM ranked WHERE rank <= 10) r USING (gene)""",
        "vals", extra=_WELCH,
    ),
)
def heatmap_table(spark, sf_dir):
    sums = materialise(markers.group_sums(bind.values(spark, sf_dir), bind.groups(spark, sf_dir)), "sums")
    return r6(markers.heatmap_table(markers.top_genes(markers.welch(sums)), sums), "value")


@query(
    "group_corr",
    with_ctes(
        f"""SELECT a."group" AS group_a, b."group" AS group_b, {rd('corr(a.s1 / a.n1, b.s1 / b.n1)')} AS corr,
              {rd('1 - corr(a.s1 / a.n1, b.s1 / b.n1)')} AS distance
            FROM gs a JOIN gs b ON a.gene = b.gene AND a."group" < b."group" GROUP BY ALL""",
        "vals", extra=_WELCH,
    ),
)
def group_corr(spark, sf_dir):
    sums = markers.group_sums(bind.values(spark, sf_dir), bind.groups(spark, sf_dir))
    return r6(markers.group_corr(sums), "corr", "distance")


# --- annotation ------------------------------------------------------------------------------

_ENRICH = _WELCH | {
    "known": "SELECT DISTINCT gene_id, tissue FROM tissue_map WHERE stage = '0'",
    "mapped": """SELECT DISTINCT "group", gene_id FROM ranked JOIN gene_map ON symbol = gene
      SEMI JOIN known USING (gene_id) WHERE rank <= 50""",
    "hit": """SELECT "group", tissue, total, marked, drawn, hits FROM
        (SELECT "group", tissue, count(*) AS hits FROM mapped JOIN known USING (gene_id) GROUP BY ALL)
        JOIN (SELECT tissue, count(*) AS marked FROM known GROUP BY ALL) USING (tissue)
        JOIN (SELECT "group", count(*) AS drawn FROM mapped GROUP BY ALL) USING ("group"),
        (SELECT count(DISTINCT gene_id) AS total FROM known)""",
    "terms": """SELECT *, lgamma(marked + 1) - lgamma(i + 1) - lgamma(marked - i + 1)
            + lgamma(total - marked + 1) - lgamma(drawn - i + 1) - lgamma(total - marked - drawn + i + 1)
            - lgamma(total + 1) + lgamma(drawn + 1) + lgamma(total - drawn + 1) AS term
      FROM (SELECT *, unnest(range(greatest(hits, drawn + marked - total), least(marked, drawn) + 1)) AS i FROM hit)""",
    "peak": """SELECT *, max(term) OVER (PARTITION BY "group", tissue) AS top FROM terms""",
    "enriched": """SELECT "group", tissue, total, marked, drawn, hits,
        least(any_value(top) + ln(sum(exp(term - top))), 0) AS log_pval,
        exp(least(any_value(top) + ln(sum(exp(term - top))), 0)) AS pval
      FROM peak GROUP BY "group", tissue, total, marked, drawn, hits""",
    "best": """SELECT "group", tissue, hits, pval FROM (SELECT *, row_number() OVER (PARTITION BY "group"
        ORDER BY round(log_pval, 9), hits DESC, tissue) AS rn FROM enriched) WHERE rn = 1""",
}


def _top(spark, sf_dir, n):
    top = markers.rank_markers(bind.values(spark, sf_dir), bind.groups(spark, sf_dir), n)
    return top.select("group", "gene", "rank")


@query(
    "gene_to_tissue",
    with_ctes(
        """SELECT "group", gene, rank, gene_id, tissue FROM ranked LEFT JOIN gene_map ON symbol = gene
           LEFT JOIN known USING (gene_id) WHERE rank <= 50""",
        "vals", "gene_map", "tissue_map", extra=_ENRICH,
    ),
)
def gene_to_tissue(spark, sf_dir):
    maps = bind.gene_map(spark, sf_dir), bind.tissue_map(spark, sf_dir)
    return annotate.gene_to_tissue(_top(spark, sf_dir, 50), *maps, ["0"])


def _enriched(spark, sf_dir):
    maps = (materialise(m, "map") for m in (bind.gene_map(spark, sf_dir), bind.tissue_map(spark, sf_dir)))
    return annotate.enrich(_top(spark, sf_dir, 50), *maps, ["0"])


@query("enrich", with_ctes("SELECT * REPLACE (round(pval, 6) AS pval, round(log_pval, 6) AS log_pval) FROM enriched", "vals", "gene_map", "tissue_map", extra=_ENRICH))
def enrich(spark, sf_dir):
    return r6(_enriched(spark, sf_dir), "pval", "log_pval")


@query(
    "bh_adjust",
    with_ctes(
        """SELECT "group", tissue, round(pval, 6) AS pval,
             round(least(min(raw) OVER (PARTITION BY "group" ORDER BY pval DESC, tissue DESC), 1), 6) AS padj
           FROM (SELECT *, pval * count(*) OVER (PARTITION BY "group")
                   / row_number() OVER (PARTITION BY "group" ORDER BY pval, tissue) AS raw
                 FROM enriched)""",
        "vals", "gene_map", "tissue_map", extra=_ENRICH,
    ),
)
def bh_adjust(spark, sf_dir):
    enriched = _enriched(spark, sf_dir).select("group", "tissue", "pval")
    return r6(markers.bh_adjust(enriched, "pval", ["group"], "tissue"), "pval", "padj")


@query("best_annotation", with_ctes("SELECT * REPLACE (round(pval, 6) AS pval) FROM best", "vals", "gene_map", "tissue_map", extra=_ENRICH))
def best_annotation(spark, sf_dir):
    return r6(annotate.best_annotation(_enriched(spark, sf_dir)), "pval")


@query(
    "annotate_cells",
    with_ctes(
        'SELECT cell, label AS cluster, tissue AS auto_anno FROM vecs LEFT JOIN best ON "group" = label',
        "vals", "gene_map", "tissue_map", extra=_ENRICH,
    ),
)
def annotate_cells(spark, sf_dir):
    best = annotate.best_annotation(_enriched(spark, sf_dir))
    return annotate.annotate_cells(bind.groups(spark, sf_dir).withColumnRenamed("group", "cluster"), best)


_ENRICH_SWEEP = _SWEEP | {
    key: sql.replace('"group"', 'resolution, "group"')
    for key, sql in _ENRICH.items()
    if key in ("known", "mapped", "hit", "terms", "peak", "enriched", "best")
}


def _sweep_top(spark, sf_dir):
    top = markers.rank_markers(bind.values(spark, sf_dir), bind.clusters(spark, sf_dir), by=["resolution"])
    return materialise(top.select("resolution", "group", "gene", "rank"), "top")


@query(
    "annotation_sweep",
    with_ctes(
        """SELECT c.resolution, cell, c."group" AS cluster, tissue AS auto_anno FROM clusters c
           LEFT JOIN best USING (resolution, "group")""",
        "vals", "clusters", "gene_map", "tissue_map", extra=_ENRICH_SWEEP,
    ),
)
def annotation_sweep(spark, sf_dir):
    """Cells annotated at every resolution; group numbers of different resolutions stay apart."""
    by = ["resolution"]
    maps = (materialise(m, "map") for m in (bind.gene_map(spark, sf_dir), bind.tissue_map(spark, sf_dir)))
    best = annotate.annotate(_sweep_top(spark, sf_dir), *maps, ["0"], by=by)
    cells = bind.clusters(spark, sf_dir).withColumnRenamed("group", "cluster")
    return annotate.annotate_cells(cells, best, by=by).select("resolution", "cell", "cluster", "auto_anno")


@query(
    "heatmap_sweep",
    with_ctes(
        """SELECT resolution, "group", gene, round(least(greatest(s1 / n1, 0.3::DOUBLE), 3), 6) AS value
           FROM gs SEMI JOIN (SELECT DISTINCT resolution, gene FROM ranked WHERE rank <= 10) r USING (resolution, gene)""",
        "vals", "clusters", extra=_SWEEP,
    ),
)
def heatmap_sweep(spark, sf_dir):
    by = ["resolution"]
    sums = materialise(markers.group_sums(bind.values(spark, sf_dir), bind.clusters(spark, sf_dir), by), "sums")
    top = markers.top_genes(markers.welch(sums, by), by=by)
    return r6(markers.heatmap_table(top, sums, by=by), "value")


@query(
    "group_corr_sweep",
    with_ctes(
        f"""SELECT a.resolution, a."group" AS group_a, b."group" AS group_b, {rd('corr(a.s1 / a.n1, b.s1 / b.n1)')} AS corr,
              {rd('1 - corr(a.s1 / a.n1, b.s1 / b.n1)')} AS distance
            FROM gs a JOIN gs b ON a.resolution = b.resolution AND a.gene = b.gene AND a."group" < b."group" GROUP BY ALL""",
        "vals", "clusters", extra=_SWEEP,
    ),
)
def group_corr_sweep(spark, sf_dir):
    by = ["resolution"]
    sums = markers.group_sums(bind.values(spark, sf_dir), bind.clusters(spark, sf_dir), by)
    return r6(markers.group_corr(sums, by), "corr", "distance")


# --- registration ----------------------------------------------------------------------------

_RIGID = {
    "pts": """SELECT CAST(right(slice, 1) AS INTEGER) AS slice_idx, cell, x AS bx, y AS b_y, area::DOUBLE AS w,
        cos(CAST(right(slice, 1) AS INTEGER) / 20.0::DOUBLE) AS c, sin(CAST(right(slice, 1) AS INTEGER) / 20.0::DOUBLE) AS s FROM props""",
    "ab": """SELECT slice_idx, cell, bx, b_y, w, c * bx - s * b_y + 3 * slice_idx AS ax,
        s * bx + c * b_y - 2 * slice_idx AS ay FROM pts""",
    "mid": """SELECT slice_idx, sum(w * ax) / sum(w) AS mx, sum(w * ay) / sum(w) AS my, sum(w * bx) / sum(w) AS nx,
        sum(w * b_y) / sum(w) AS ny FROM ab GROUP BY slice_idx""",
    "fit": """SELECT slice_idx, mx, my, nx, ny,
        atan2(sum(w * ((ax - mx) * (b_y - ny) - (ay - my) * (bx - nx))), sum(w * ((ax - mx) * (bx - nx) + (ay - my) * (b_y - ny)))) AS theta
      FROM ab JOIN mid USING (slice_idx) GROUP BY ALL""",
    "trans": """SELECT slice_idx, theta, nx - (cos(theta) * mx - sin(theta) * my) AS tx,
        ny - (sin(theta) * mx + cos(theta) * my) AS ty FROM fit""",
}


@query(
    "rigid_fit",
    with_ctes(f"SELECT slice_idx, {rd('theta')} AS theta, {rd('tx')} AS tx, {rd('ty')} AS ty FROM trans", "props", extra=_RIGID),
)
def rigid_fit(spark, sf_dir):
    return r6(align.rigid_fit(bind.rigid_points(spark, sf_dir)), "theta", "tx", "ty")


@query(
    "apply_transform",
    with_ctes(
        f"""SELECT slice_idx, cell, {rd('cos(theta) * ax - sin(theta) * ay + tx')} AS align_x,
              {rd('sin(theta) * ax + cos(theta) * ay + ty')} AS align_y FROM ab JOIN trans USING (slice_idx)""",
        "props", extra=_RIGID,
    ),
)
def apply_transform(spark, sf_dir):
    points = materialise(bind.rigid_points(spark, sf_dir), "points")
    cells = points.selectExpr("slice_idx", "cell", "ax AS x", "ay AS y")
    moved = align.apply_transform(cells, materialise(align.rigid_fit(points), "fit"))
    return r6(moved.drop("x", "y"), "align_x", "align_y")


@query(
    "spatial_sample",
    with_ctes(
        """SELECT slice, cell, round(x, 6) AS x, round(y, 6) AS y FROM (
             SELECT *, row_number() OVER (PARTITION BY slice ORDER BY turn, key, cell) AS pos FROM (
               SELECT *, row_number() OVER (PARTITION BY slice, gx, gy ORDER BY key, cell) AS turn FROM (
                 SELECT slice, cell, x, y, md5(concat_ws('|', cell, 0)) AS key,
                   coalesce(least(floor((x - min(x) OVER s) / nullif(max(x) OVER s - min(x) OVER s, 0) * 16), 15), 0) AS gx,
                   coalesce(least(floor((y - min(y) OVER s) / nullif(max(y) OVER s - min(y) OVER s, 0) * 16), 15), 0) AS gy
                 FROM bins1 WINDOW s AS (PARTITION BY slice)))) WHERE pos <= 2000""",
        "pixels",
        extra={"bins1": "SELECT slice, CAST(x * 1000 + y AS BIGINT) AS cell, x::DOUBLE AS x, y::DOUBLE AS y FROM pixels"},
    ),
)
def spatial_sample(spark, sf_dir):
    cells = bind.pixels(spark, sf_dir).selectExpr(
        "slice", "cast(x * 1000 + y AS bigint) AS cell", "double(x) AS x", "double(y) AS y"
    )
    return r6(align.spatial_sample(cells), "x", "y")


@query(
    "register_slices",
    f"""SELECT CAST(i AS INTEGER) AS slice_idx, {rd('-a', 5)} AS theta, {rd('-(cos(a) * 3 * i + sin(a) * -2 * i)', 5)} AS tx,
          {rd('-(-sin(a) * 3 * i + cos(a) * -2 * i)', 5)} AS ty
        FROM (SELECT i, i / 20.0::DOUBLE AS a FROM (SELECT unnest(range(0, 7)) AS i))""",
)
def register_slices(spark, sf_dir):
    """Slices turned by known angles: the exact inverse must come back."""
    return r6(align.register_slices(bind.turned_slices(spark, sf_dir)), "theta", "tx", "ty", digits=5)


@query("register_softly", QUERIES["register_slices"].oracle)  # the same planted turns
def register_softly(spark, sf_dir):
    """The same turns from vectors that are noisy or tell nothing."""
    return r6(soft.register_softly(bind.noisy_slices(spark, sf_dir)), "theta", "tx", "ty", digits=5)


_SCALED = {
    "own": """SELECT DISTINCT CAST(right(slice, 1) AS INTEGER) AS pair, CAST(x // 5 * 1000 + y // 5 AS BIGINT) AS cell, x // 5 AS gx, y // 5 AS gy FROM clean""",
    "kernel": """SELECT a.pair, a.cell AS src, b.cell AS dst,
        exp(-((a.gx - b.gx) * (a.gx - b.gx) + (a.gy - b.gy) * (a.gy - b.gy) + (a.cell * 7 + b.cell * 13) % 10 / 10.0::DOUBLE)) AS k
      FROM own a JOIN own b ON a.pair = b.pair + 1 AND abs(a.gx - b.gx) <= 1 AND abs(a.gy - b.gy) <= 1""",
    "v0": "SELECT DISTINCT pair, dst, 1.0::DOUBLE AS v FROM kernel",
} | {
    name: sql
    for i in range(5)
    for name, sql in (
        (f"u{i}", f"SELECT pair, src, power(1 / sum(k * v), 0.5) AS u FROM kernel JOIN v{i} USING (pair, dst) GROUP BY ALL"),
        (f"v{i + 1}", f"SELECT pair, dst, power(1 / sum(k * u), 0.5) AS v FROM kernel JOIN u{i} USING (pair, src) GROUP BY ALL"),
    )
} | {"u5": "SELECT pair, src, power(1 / sum(k * v), 0.5) AS u FROM kernel JOIN v5 USING (pair, dst) GROUP BY ALL"}


@query(
    "soft_weights",
    with_ctes(
        f"SELECT pair, src, dst, {rd('u * k * v')} AS w FROM kernel JOIN u5 USING (pair, src) JOIN v5 USING (pair, dst)",
        "clean", extra=_SCALED,
    ),
)
def soft_weights(spark, sf_dir):
    return r6(soft.scale_pairs(bind.cell_overlaps(spark, sf_dir), ["pair"]).drop("cost"), "w")


# --- components ------------------------------------------------------------------------------


@query("pca")
def pca(spark, sf_dir):
    """Sign-free view of the scores: norm of each cell's component vector."""
    _, scores = reduce.fit_pca(bind.vecs(spark, sf_dir).select("cell", "vec"))
    square = F.aggregate("X_pca", F.lit(0.0), lambda a, v: a + v * v)
    return scores.select("cell", F.size("X_pca").alias("dims"), F.round(F.sqrt(square), 6).alias("norm"))


@query(
    "pca_norms",
    """SELECT vec_id AS cell, round(sqrt(sum((v - m) * (v - m))), 6) AS norm FROM (
         SELECT vec_id, v, avg(v) OVER (PARTITION BY i) AS m FROM (
           SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS v FROM (
             SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)))
       GROUP BY vec_id""",
)
def pca_norms(spark, sf_dir):
    """With all components kept, scores are a rotation: they have the length of the centred vector."""
    cells = bind.vecs(spark, sf_dir, planted=False).select("cell", "vec")
    width = cells.select(F.size("vec").alias("n")).first()["n"]
    _, scores = reduce.fit_pca(cells, k=width)
    square = F.aggregate("X_pca", F.lit(0.0), lambda a, v: a + v * v)
    return scores.select("cell", F.round(F.sqrt(square), 6).alias("norm"))


@query("n_components")
def n_components(spark, sf_dir):
    """Components of the loading matrix that explain 90 % of its variance."""
    found, _ = reduce.fit_pca(bind.vecs(spark, sf_dir).select("cell", "vec"))
    return reduce.n_components(reduce.loadings_table(found, spark))


# --- stacked slices --------------------------------------------------------------------------


def _residuals(spark, sf_dir):
    counts = materialise(bind.counts(spark, sf_dir), "counts")
    resid = normalize.pearson_resid(qc.qc_filter(counts, bind.cells(spark, sf_dir)))
    return materialise(resid.select("slice", "cell", "gene", F.col("resid").alias("value")), "residuals")


@query(
    "stacked_vectors",
    with_ctes(
        f"""SELECT a.slice, a.cell, round(any_value(c.x), 6) AS x, round(any_value(c.y), 6) AS y, CAST(right(a.slice, 1) AS INTEGER) * 14.0 AS z,
              {rd('sqrt(sum((coalesce(resid, 0) - mean) ** 2))', 5)} AS norm
            FROM (SELECT slice, cell, gene, mean FROM placed, means) a
            JOIN cells c ON c.slice = a.slice AND c.cell = a.cell
            LEFT JOIN resid_tab r ON r.slice = a.slice AND r.cell = a.cell AND r.gene = a.gene GROUP BY a.slice, a.cell""",
        "kept", "cells",
        extra={
            "resid_tab": RESID_SQL,
            "placed": "SELECT DISTINCT slice, cell FROM resid_tab",
            "means": "SELECT gene, sum(resid) / (SELECT count(*) FROM placed) AS mean FROM resid_tab GROUP BY gene",
        },
    ),
)
def stacked_vectors(spark, sf_dir):
    """From spots to vectors over slices whose cell ids repeat; with all components scores keep the length."""
    found = longpca.fit_pca_long(_residuals(spark, sf_dir), 1000)
    placed = longpca.numbered_cells(found.scores, bind.cells(spark, sf_dir))
    square = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v)
    place = [F.round(F.col("xyz")[i], 6).alias(c) for i, c in enumerate("xyz")]
    return placed.select("slice", F.col("slice_cell").alias("cell"), *place, F.round(F.sqrt(square), 5).alias("norm"))


@query("stacked_markers")
def stacked_markers(spark, sf_dir):
    """From spots to ranked markers: residuals, components, graph in both spaces, communities, Welch ranks.

    The counts hold no planted groups, so five rounds of components and two of communities must do here.
    """
    values = _residuals(spark, sf_dir)
    found = longpca.fit_pca_long(values, 20, rounds=5)
    placed = longpca.numbered_cells(found.scores, bind.cells(spark, sf_dir))
    near = neighbors.knn_join(placed, placed, 15, exclude_self=True).select("src", "dst")
    beside = grid.grid_knn(placed, 6).select("src", "dst")
    edges = neighbors.symmetric_edges(near.unionByName(beside))
    groups = communities.communities(materialise(edges, "graph"), (1.2,), rounds=2, levels=1).select(F.col("node").alias("cell"), F.col("community").alias("group"))
    top = markers.rank_markers(longpca.by_number(values, placed), materialise(groups, "groups"))
    return r6(top.select("group", "gene", "rank", "score"), "score")
