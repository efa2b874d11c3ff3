"""How the given tables become spots, labels, cells and vectors.

Each binding exists twice: as a DataFrame here and as a common table expression in ``CTES`` for
the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tissueloom.operators import spots as sp


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('L3-early_a_S0', l_linenumber) AS slice",
        "CASE l_suppkey % 50 WHEN 0 THEN 'mt:A' WHEN 1 THEN 'mt:B' WHEN 2 THEN 'mt:C' WHEN 3 THEN NULL"
        " ELSE concat('g', lpad(cast(l_suppkey % 50 AS string), 2, '0')) END AS gene",
        "cast(100 + l_orderkey % 100 AS int) AS x",
        "cast(200 + l_partkey % 100 AS int) AS y",
        "cast(l_quantity AS bigint) % 5 + 1 AS cnt",
    )


def pixels(spark, sf_dir) -> DataFrame:
    return spots(spark, sf_dir).select("slice", "x", "y").distinct()


def labels(spark, sf_dir) -> DataFrame:
    return pixels(spark, sf_dir).selectExpr(
        "slice", "x", "y",
        "cast(CASE WHEN (x - 100) % 10 < 6 AND (y - 200) % 10 < 6"
        " THEN ((x - 100) div 10) * 10 + ((y - 200) div 10) + 1 ELSE 0 END AS bigint) AS label",
    )


def raster(spark, sf_dir) -> DataFrame:
    """Label raster: one row per (slice, row index), one array element per column."""
    return (
        labels(spark, sf_dir)
        .groupBy("slice", F.expr("x - 100").alias("x"))
        .agg(F.map_from_entries(F.collect_list(F.struct(F.expr("y - 200"), "label"))).alias("m"))
        .select("slice", "x", F.expr("transform(sequence(0, 99), i -> coalesce(m[i], 0L))").alias("labels"))
    )


def mask(spark, sf_dir) -> DataFrame:
    return pixels(spark, sf_dir).selectExpr(
        "slice", "x", "y", "CASE WHEN x - 100 >= 80 THEN 0 ELSE (x * 7 + y * 13) % 256 END AS value"
    )


def image(spark, sf_dir) -> DataFrame:
    return sp.count_image_byte(spots(spark, sf_dir))


def clean(spark, sf_dir) -> DataFrame:
    return sp.fill_gene(sp.rebase_spots(spots(spark, sf_dir)))


def bins(spark, sf_dir, size: int) -> DataFrame:
    return sp.bin_spots(clean(spark, sf_dir), size).withColumn(
        "cell", F.expr("cast(bx * 1000 + by AS bigint)")
    )


def counts(spark, sf_dir) -> DataFrame:
    return bins(spark, sf_dir, 5).select("slice", "cell", "gene", "cnt")


def cells(spark, sf_dir) -> DataFrame:
    squares = clean(spark, sf_dir).selectExpr("slice", "x div 5 AS bx", "y div 5 AS b_y").distinct()
    return squares.selectExpr(
        "slice", "bx * 1000 + b_y AS cell", "(bx + 0.5D) * 5 AS x", "(b_y + 0.5D) * 5 AS y", "25L AS area"
    )


def params(spark, sf_dir) -> DataFrame:
    return (
        spots(spark, sf_dir)
        .select("slice")
        .distinct()
        .selectExpr("slice", "cast(right(slice, 1) AS int) AS n")
        .selectExpr(
            "'L3-early' AS stage", "slice", "cast(n AS double) AS dilation_distance",
            "n * 0.5D AS amount", "2 * n + 1 AS block_size", "cast(n + 1 AS double) AS radius",
            "2 + n % 2 AS otsu_class", "CASE WHEN n % 4 = 1 THEN 1 ELSE 0 END AS otsu_index",
        )
    )


def sc_cells(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id AS cell_id", "CASE WHEN vec_id % 2 = 0 THEN 'RNA' ELSE 'ATAC' END AS assay",
        "cast(vec_id % 3 AS int) AS stage", "concat('s', label % 3) AS state",
        "cast(embedding AS array<double>) AS emb",
    )


def vecs(spark, sf_dir, planted: bool = True) -> DataFrame:
    """Cells with an expression vector and a position; planted: element ``label`` is raised by 1."""
    lift = "transform(e, (v, i) -> v + CASE WHEN i = label THEN 1D ELSE 0D END)" if planted else "e"
    return (
        table(spark, sf_dir, "embeddings")
        .selectExpr("vec_id AS cell", "label", "cast(embedding AS array<double>) AS e")
        .selectExpr("cell", "label", f"{lift} AS vec", "slice(e, 1, 3) AS xyz")
    )


def values(spark, sf_dir, planted: bool = True) -> DataFrame:
    return vecs(spark, sf_dir, planted).select("cell", F.posexplode("vec").alias("pos", "value")).selectExpr(
        "cell", "concat('d', pos) AS gene", "value"
    )


def order_profiles(spark, sf_dir) -> DataFrame:
    """Cells in twelve dimensions: an order's quantity by month of shipping."""
    month = F.month("l_shipdate")
    parts = [F.sum(F.when(month == m, F.col("l_quantity").cast("double")).otherwise(0.0)).alias(f"m{m}") for m in range(1, 13)]
    sums = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*parts)
    return sums.select(F.col("l_orderkey").alias("cell"), F.array(*[f"m{m}" for m in range(1, 13)]).alias("vec"))


def groups(spark, sf_dir) -> DataFrame:
    return vecs(spark, sf_dir).selectExpr("cell", "label AS `group`")


def clusters(spark, sf_dir) -> DataFrame:
    """Six clusterings: resolution number r merges the labels into 5 + r groups."""
    return vecs(spark, sf_dir).select("cell", "label", F.explode(F.expr("sequence(0, 5)")).alias("r")).selectExpr(
        "(12 + 2 * r) / 10D AS resolution", "cell", "label % (5 + r) AS `group`"
    )


def gene_map(spark, sf_dir) -> DataFrame:
    return values(spark, sf_dir).select("gene").distinct().selectExpr(
        "gene AS symbol", "cast(substring(gene, 2) AS int) AS i"
    ).filter("i < 60").selectExpr("symbol", "concat('FB', i) AS gene_id")


def tissue_map(spark, sf_dir) -> DataFrame:
    ids = gene_map(spark, sf_dir).selectExpr("gene_id", "cast(substring(gene_id, 3) AS int) AS i")
    first = ids.selectExpr("gene_id", "cast(i % 2 AS string) AS stage", "concat('t', i % 7) AS tissue")
    second = ids.filter("i % 5 = 0").selectExpr(
        "gene_id", "cast(i % 2 AS string) AS stage", "concat('t', (i + 1) % 7) AS tissue"
    )
    return first.unionByName(second)


def images(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('E', 2 * (o_orderkey % 10), '-', 2 * (o_orderkey % 10) + 2, 'h_',"
        " element_at(array('a', 'b', 'c'), cast(o_orderkey % 3 AS int) + 1),"
        " '_S', lpad(cast(o_orderkey % 30 AS string), 2, '0'),"
        " '_SS', lpad(cast(o_custkey AS string), 9, '0'),"
        " CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '_A1' WHEN 2 THEN '_A1_x' ELSE '_B2_y' END,"
        " '.tif') AS image"
    )


def files(spark, sf_dir) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    name = (
        "'/SS', lpad(cast(c_custkey AS string), 9, '0'), CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '_A1'"
        " WHEN 2 THEN '_B2' ELSE '_A1_x' END, '.gem.gz'"
    )
    return customer.selectExpr(f"concat('/raw/', c_nationkey, {name}) AS path").unionByName(
        customer.filter("c_custkey % 5 = 0").selectExpr(f"concat('/second/', c_nationkey, {name}) AS path")
    )


def rigid_points(spark, sf_dir) -> DataFrame:
    """Cells of each slice (b) and the same cells turned by slice_idx / 20 and shifted (a)."""
    props = sp.cell_props(labels(spark, sf_dir))
    return props.selectExpr(
        "cast(right(slice, 1) AS int) AS slice_idx", "cell", "x AS bx", "y AS `by`", "cast(area AS double) AS w"
    ).selectExpr(
        "slice_idx", "cell", "bx", "`by`", "w",
        "cos(slice_idx / 20D) * bx - sin(slice_idx / 20D) * `by` + 3 * slice_idx AS ax",
        "sin(slice_idx / 20D) * bx + cos(slice_idx / 20D) * `by` - 2 * slice_idx AS ay",
    )


def turned_slices(spark, sf_dir) -> DataFrame:
    """The tissue of all slices together, seven times, each copy turned and shifted a little more."""
    squares = clean(spark, sf_dir).selectExpr("x div 5 AS bx", "y div 5 AS b_y").distinct()
    return (
        squares.selectExpr("bx * 1000 + b_y AS cell", "(bx + 0.5D) * 5 AS px", "(b_y + 0.5D) * 5 AS py")
        .select("*", F.explode(F.expr("sequence(0, 6)")).alias("slice_idx"))
        .selectExpr(
            "concat('turned_S', slice_idx) AS slice", "slice_idx", "cell", "array(px, py) AS vec",
            "cos(slice_idx / 20D) * px - sin(slice_idx / 20D) * py + 3 * slice_idx AS x",
            "sin(slice_idx / 20D) * px + cos(slice_idx / 20D) * py - 2 * slice_idx AS y",
        )
    )


def noisy_slices(spark, sf_dir) -> DataFrame:
    """``turned_slices`` with vectors that are off by up to 8 units each way; every third one is any place at all."""
    noise = "conv(substr(md5(concat_ws('|', cell, slice_idx, {})), 1, 8), 16, 10) / 4294967296D - 0.5D"
    return turned_slices(spark, sf_dir).selectExpr(
        "slice", "slice_idx", "cell", "x", "y",
        f"transform(vec, (v, i) -> CASE WHEN (cell + slice_idx) % 3 = 0 THEN 100 * ({noise.format('i')} + 0.5D)"
        f" ELSE v + 16 * ({noise.format('i')}) END) AS vec",
    )


def cell_overlaps(spark, sf_dir) -> DataFrame:
    """Squares of consecutive slices at most one square apart, with a cost for distance and for unlike numbers."""
    own = cells(spark, sf_dir).selectExpr("cast(right(slice, 1) AS int) AS pair", "cell", "cell div 1000 AS gx", "cell % 1000 AS gy")
    near = own.selectExpr("pair + 1 AS pair", "cell AS dst", "gx AS hx", "gy AS hy").selectExpr(
        "*", "explode(sequence(-1, 1)) AS dx"
    ).selectExpr("*", "explode(sequence(-1, 1)) AS dy")
    return own.join(near.selectExpr("pair", "dst", "dx", "dy", "hx + dx AS gx", "hy + dy AS gy"), ["pair", "gx", "gy"]).selectExpr(
        "pair", "cell AS src", "dst", "dx * dx + dy * dy + (cell * 7 + dst * 13) % 10 / 10D AS cost"
    )


def transitions_table(spark, sf_dir) -> DataFrame:
    """Weighted state changes between consecutive lines of an order, as an edge list."""
    raw = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('E', l_linenumber, ':early/', l_returnflag, ' ', l_linestatus) AS parent",
        "concat('E', l_linenumber + 1, ':late ', l_suppkey % 10) AS child",
    )
    pairs = raw.groupBy("parent", "child").agg(F.count("*").alias("n"))
    total = pairs.groupBy("child").agg(F.sum("n").alias("t"))
    return pairs.join(total, "child").selectExpr("parent", "child", "round(n / t, 6) AS prob")


def line_chain(spark, sf_dir) -> DataFrame:
    """Share of each state of the next line of an order that comes from each state of this line."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber AS n", "concat(l_returnflag, l_linestatus, l_suppkey % 2) AS state"
    )
    after = lines.selectExpr("l_orderkey", "n - 1 AS n", "state AS next")
    pairs = lines.join(after, ["l_orderkey", "n"]).groupBy("n", "state", "next").agg(F.count("*").alias("k"))
    total = pairs.groupBy("n", "next").agg(F.sum("k").alias("t"))
    return pairs.join(total, ["n", "next"]).selectExpr(
        "concat('E', n, ':', state) AS parent", "concat('E', n + 1, ':', next) AS child", "round(k / t, 6) AS prob"
    )


def outlines(spark, sf_dir) -> DataFrame:
    """Per slice an outer ring, a hole and a thin triangle, moved by the slice's number."""
    rings = [
        (0, [(110, 210), (180, 205), (195, 290), (150, 250), (105, 285)]),
        (1, [(140, 230), (160, 230), (160, 245), (140, 245)]),
        (2, [(101, 203), (199, 201), (150, 202)]),
    ]
    points = ", ".join(f"struct({r} AS ring, {i} AS seq, {x} AS x, {y} AS y)" for r, ring in rings for i, (x, y) in enumerate(ring))
    slices = spots(spark, sf_dir).select("slice").distinct().selectExpr("slice", "cast(right(slice, 1) AS int) AS n")
    return slices.selectExpr("slice", "n", f"inline(array({points}))").selectExpr("slice", "ring", "seq", "x + n % 3 AS x", "y + n AS y")


CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "spots": (
        """SELECT 'L3-early_a_S0' || l_linenumber AS slice,
             CASE l_suppkey % 50 WHEN 0 THEN 'mt:A' WHEN 1 THEN 'mt:B' WHEN 2 THEN 'mt:C' WHEN 3 THEN NULL
               ELSE 'g' || lpad(CAST(l_suppkey % 50 AS VARCHAR), 2, '0') END AS gene,
             CAST(100 + l_orderkey % 100 AS INTEGER) AS x, CAST(200 + l_partkey % 100 AS INTEGER) AS y,
             CAST(l_quantity AS BIGINT) % 5 + 1 AS cnt FROM lineitem""",
        (),
    ),
    "pixels": ("SELECT DISTINCT slice, x, y FROM spots", ("spots",)),
    "label_px": (
        """SELECT slice, x, y, CAST(CASE WHEN (x - 100) % 10 < 6 AND (y - 200) % 10 < 6
             THEN ((x - 100) // 10) * 10 + ((y - 200) // 10) + 1 ELSE 0 END AS BIGINT) AS label FROM pixels""",
        ("pixels",),
    ),
    "mask": (
        """SELECT slice, x, y, CASE WHEN x - 100 >= 80 THEN 0 ELSE (x * 7 + y * 13) % 256 END AS value
           FROM pixels""",
        ("pixels",),
    ),
    "image": (
        """SELECT slice, x, y, CAST(least(sum(cnt)::BIGINT, 10) * 255 // 10 AS INTEGER) AS value
           FROM spots GROUP BY slice, x, y""",
        ("spots",),
    ),
    "origin": ("SELECT slice, min(x) AS min_x, min(y) AS min_y FROM spots GROUP BY slice", ("spots",)),
    "clean": (
        """SELECT slice, coalesce(gene, 'CG5842') AS gene, x - min_x AS x, y - min_y AS y, cnt
           FROM spots JOIN origin USING (slice)""",
        ("spots", "origin"),
    ),
    "bin5": (
        """SELECT slice, CAST(floor(x / 5) AS INTEGER) AS bx, CAST(floor(y / 5) AS INTEGER) AS b_y, gene,
             sum(cnt)::BIGINT AS cnt FROM clean GROUP BY ALL""",
        ("clean",),
    ),
    "counts": (
        "SELECT slice, CAST(bx * 1000 + b_y AS BIGINT) AS cell, gene, cnt FROM bin5",
        ("bin5",),
    ),
    "cells": (
        """SELECT DISTINCT slice, CAST(bx * 1000 + b_y AS BIGINT) AS cell, (bx + 0.5::DOUBLE) * 5 AS x,
             (b_y + 0.5::DOUBLE) * 5 AS y, 25 AS area FROM bin5""",
        ("bin5",),
    ),
    "stats": (
        """SELECT slice, cell, count(*) FILTER (cnt > 0) AS n_genes, sum(cnt)::BIGINT AS n_counts,
             sum(CASE WHEN gene LIKE 'mt:%' THEN cnt ELSE 0 END)::BIGINT AS mt_counts,
             CAST(sum(CASE WHEN gene LIKE 'mt:%' THEN cnt ELSE 0 END) AS DOUBLE) / nullif(sum(cnt)::BIGINT, 0) AS p_mito
           FROM counts GROUP BY slice, cell""",
        ("counts",),
    ),
    "good_cells": (
        """SELECT s.*, c.area FROM stats s JOIN cells c USING (slice, cell)
           WHERE p_mito < 0.1::DOUBLE AND n_genes >= 20 AND area >= 20""",
        ("stats", "cells"),
    ),
    "good_genes": (
        """SELECT slice, gene, count(*) FILTER (cnt > 0) AS n_cells, sum(cnt)::BIGINT AS n_counts
           FROM counts SEMI JOIN good_cells USING (slice, cell) GROUP BY slice, gene
           HAVING count(*) FILTER (cnt > 0) >= 3 AND sum(cnt)::BIGINT >= 1""",
        ("counts", "good_cells"),
    ),
    "kept": (
        """SELECT * FROM counts SEMI JOIN good_cells USING (slice, cell)
           SEMI JOIN good_genes USING (slice, gene)""",
        ("counts", "good_cells", "good_genes"),
    ),
    "kept_stats": (
        """SELECT slice, cell, count(*) FILTER (cnt > 0) AS n_genes, sum(cnt)::BIGINT AS n_counts,
             CAST(sum(CASE WHEN gene LIKE 'mt:%' THEN cnt ELSE 0 END) AS DOUBLE) / nullif(sum(cnt)::BIGINT, 0) AS p_mito
           FROM kept GROUP BY slice, cell""",
        ("kept",),
    ),
    "props": (
        """SELECT slice, label AS cell, count(*) AS area, avg(x) AS x, avg(y) AS y, min(x) AS x_min,
             max(x) AS x_max, min(y) AS y_min, max(y) AS y_max FROM label_px WHERE label <> 0
           GROUP BY slice, label""",
        ("label_px",),
    ),
    "params": (
        """SELECT 'L3-early' AS stage, slice, CAST(n AS DOUBLE) AS dilation_distance,
             n * 0.5::DOUBLE AS amount, 2 * n + 1 AS block_size, CAST(n + 1 AS DOUBLE) AS radius,
             2 + n % 2 AS otsu_class, CASE WHEN n % 4 = 1 THEN 1 ELSE 0 END AS otsu_index
           FROM (SELECT DISTINCT slice, CAST(right(slice, 1) AS INTEGER) AS n FROM spots)""",
        ("spots",),
    ),
    "sc_cells": (
        """SELECT vec_id AS cell_id, CASE WHEN vec_id % 2 = 0 THEN 'RNA' ELSE 'ATAC' END AS assay,
             CAST(vec_id % 3 AS INTEGER) AS stage, 's' || (label % 3) AS state,
             CAST(embedding AS DOUBLE[]) AS emb FROM embeddings""",
        (),
    ),
    "vecs": (
        """SELECT vec_id AS cell, label,
             list_transform(CAST(embedding AS DOUBLE[]), lambda v, i:
               v + CASE WHEN i = label + 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS vec,
             CAST(embedding AS DOUBLE[])[1:3] AS xyz FROM embeddings""",
        (),
    ),
    "vals": (
        """SELECT cell, label, 'd' || (i - 1) AS gene, vec[i] AS value
           FROM (SELECT cell, label, vec, unnest(range(1, len(vec) + 1)) AS i FROM vecs)""",
        ("vecs",),
    ),
    "clusters": (
        """SELECT (12 + 2 * r) / 10.0::DOUBLE AS resolution, cell, label % (5 + r) AS "group"
           FROM vecs, (SELECT unnest(range(0, 6)) AS r)""",
        ("vecs",),
    ),
    "gene_map": (
        """SELECT DISTINCT gene AS symbol, 'FB' || substr(gene, 2) AS gene_id,
             CAST(substr(gene, 2) AS INTEGER) AS i FROM vals WHERE CAST(substr(gene, 2) AS INTEGER) < 60""",
        ("vals",),
    ),
    "tissue_map": (
        """SELECT gene_id, CAST(i % 2 AS VARCHAR) AS stage, 't' || (i % 7) AS tissue FROM gene_map
           UNION ALL SELECT gene_id, CAST(i % 2 AS VARCHAR), 't' || ((i + 1) % 7) FROM gene_map
           WHERE i % 5 = 0""",
        ("gene_map",),
    ),
    "images": (
        """SELECT 'E' || 2 * (o_orderkey % 10) || '-' || (2 * (o_orderkey % 10) + 2) || 'h_' ||
             (['a', 'b', 'c'])[o_orderkey % 3 + 1] || '_S' || lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0') ||
             '_SS' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') ||
             CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '_A1' WHEN 2 THEN '_A1_x' ELSE '_B2_y' END ||
             '.tif' AS image FROM orders""",
        (),
    ),
    "parsed": (
        """SELECT image, array_to_string(regexp_split_to_array(left(image, length(image) - 4), '_\\s*')[1:3], '_')
             AS project, regexp_extract(image, '(SS.+?).tif', 1) AS chip FROM images""",
        ("images",),
    ),
    "files": (
        """SELECT folder || c_nationkey || '/SS' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') ||
             CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '_A1' WHEN 2 THEN '_B2' ELSE '_A1_x' END ||
             '.gem.gz' AS path
           FROM customer, (SELECT '/raw/' AS folder UNION ALL SELECT '/second/')
           WHERE folder = '/raw/' OR c_custkey % 5 = 0""",
        (),
    ),
    "catalog": (
        """SELECT left(name, length(name) - 7) AS key, max(path) AS path
           FROM (SELECT path, regexp_extract(path, '[^/]*$') AS name FROM files) GROUP BY 1""",
        ("files",),
    ),
    "slice_idx": (
        """SELECT slice, row_number() OVER (ORDER BY slice) - 1 AS slice_idx
           FROM (SELECT DISTINCT slice FROM spots)""",
        ("spots",),
    ),
    "line_chain": (
        """SELECT 'E' || n || ':' || state AS parent, 'E' || (n + 1) || ':' || next AS child,
             round(count(*) / sum(count(*)) OVER (PARTITION BY n, next), 6) AS prob
           FROM (SELECT l_orderkey, l_linenumber AS n, l_returnflag || l_linestatus || l_suppkey % 2 AS state FROM lineitem)
           JOIN (SELECT l_orderkey, l_linenumber - 1 AS n, l_returnflag || l_linestatus || l_suppkey % 2 AS next FROM lineitem)
             USING (l_orderkey, n) GROUP BY n, state, next""",
        (),
    ),
    "outlines": (
        """SELECT slice, ring, seq, x + n % 3 AS x, y + n AS y FROM
             (SELECT DISTINCT slice, CAST(right(slice, 1) AS INTEGER) AS n FROM spots),
             (VALUES (0, 0, 110, 210), (0, 1, 180, 205), (0, 2, 195, 290), (0, 3, 150, 250), (0, 4, 105, 285),
               (1, 0, 140, 230), (1, 1, 160, 230), (1, 2, 160, 245), (1, 3, 140, 245),
               (2, 0, 101, 203), (2, 1, 199, 201), (2, 2, 150, 202)) v(ring, seq, x, y)""",
        ("spots",),
    ),
    "edge_table": (
        """SELECT parent, child, round(n / sum(n) OVER (PARTITION BY child), 6) AS prob FROM (
             SELECT 'E' || l_linenumber || ':early/' || l_returnflag || ' ' || l_linestatus AS parent,
               'E' || (l_linenumber + 1) || ':late ' || (l_suppkey % 10) AS child, count(*) AS n
             FROM lineitem GROUP BY 1, 2)""",
        (),
    ),
}


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """``body`` preceded by the named expressions and everything they use."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for need in CTES[name][1]:
                add(need)
            order.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({CTES[n][0]})" for n in order] + [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" if parts else "") + body
