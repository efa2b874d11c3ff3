"""Queries on spots, cells, pixels and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tissueloom.operators import local, names, normalize, outline, pixels, qc, touching
from tissueloom.operators import spots as sp
from tissueloom.plans import bindings as bind
from tissueloom.plans.bindings import with_ctes
from tissueloom.plans.registry import query, rd
from tissueloom.sources import tables
from tissueloom.sources.storage import fresh_path, materialise


def r6(df, *cols, digits=6):
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c), digits))
    return df


# --- scans and sinks -------------------------------------------------------------------------


@query("scan_spots", with_ctes("SELECT slice, gene, x, y, cnt FROM spots", "spots"))
def scan_spots(spark, sf_dir):
    path = fresh_path(spark, "spots-tsv")
    tables.write_spots(bind.spots(spark, sf_dir), path)
    return tables.scan_spots(spark, path)


@query(
    "sink_roundtrip",
    with_ctes("SELECT slice, gene, x, y, cnt FROM clean", "clean"),
)
def sink_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "clean-tsv")
    tables.write_spots(bind.clean(spark, sf_dir), path)
    return tables.scan_spots(spark, path)


@query(
    "scan_cells",
    with_ctes(
        "SELECT cell_id, assay, stage, state, len(emb) AS dims, "
        + rd("emb[1]") + " AS first, " + rd("list_sum(emb)") + " AS total FROM sc_cells",
        "sc_cells",
    ),
)
def scan_cells(spark, sf_dir):
    path = fresh_path(spark, "sc-cells")
    tables.write_by(bind.sc_cells(spark, sf_dir), path, "stage")
    cells = tables.scan_cells(spark, path)
    total = F.aggregate("emb", F.lit(0.0), lambda a, v: a + v)
    return cells.select(
        "cell_id", "assay", "stage", "state", F.size("emb").alias("dims"),
        F.round(F.element_at("emb", 1), 6).alias("first"), F.round(total, 6).alias("total"),
    )


@query(
    "scan_matrix",
    with_ctes(
        """SELECT slice, cell, x, y, area, n_genes, cnt FROM cells JOIN (SELECT slice, cell, count(*) AS n_genes,
             sum(cnt)::BIGINT AS cnt FROM counts GROUP BY ALL) USING (slice, cell)""",
        "cells", "counts",
    ),
)
def scan_matrix(spark, sf_dir):
    """Write the table set of the stacked matrix by slice and read it back."""
    path = fresh_path(spark, "matrix")
    tables.write_matrix(path, cells=bind.cells(spark, sf_dir), counts=bind.counts(spark, sf_dir))
    key = "slice string, cell bigint"
    cells = tables.scan_matrix(spark, path, "cells", f"{key}, x double, y double, area bigint")
    counts = tables.scan_matrix(spark, path, "counts", f"{key}, gene string, cnt bigint")
    sums = counts.groupBy("slice", "cell").agg(F.count("*").alias("n_genes"), F.sum("cnt").alias("cnt"))
    return cells.join(sums, ["slice", "cell"])


@query("file_catalog", with_ctes("SELECT key, path FROM catalog", "catalog"))
def file_catalog(spark, sf_dir):
    return names.file_catalog(bind.files(spark, sf_dir))


@query("file_batch", with_ctes("SELECT DISTINCT path FROM files ORDER BY path LIMIT 4", "files"))
def file_batch(spark, sf_dir):
    return names.file_batch(bind.files(spark, sf_dir), 4)


@query(
    "edge_scan",
    with_ctes(
        """SELECT split_part(parent, ':', 1) AS pre_stage, substr(parent, strpos(parent, ':') + 1) AS pre_state,
             split_part(child, ':', 1) AS nex_stage, substr(child, strpos(child, ':') + 1) AS nex_state, prob
           FROM edge_table""",
        "edge_table",
    ),
)
def edge_scan(spark, sf_dir):
    path = fresh_path(spark, "edges-tsv")
    tables.write_edges(bind.transitions_table(spark, sf_dir), path)
    return tables.edge_scan(spark, path)


@query("slice_origin", with_ctes("SELECT slice, min_x, min_y FROM origin", "origin"))
def slice_origin(spark, sf_dir):
    path = fresh_path(spark, "origin")
    tables.write_by(sp.slice_origin(bind.spots(spark, sf_dir)), path, "slice")
    return spark.read.schema("slice string, min_x int, min_y int").parquet(path)


# --- projections -----------------------------------------------------------------------------


@query("count_image", with_ctes("SELECT slice, x, y, sum(cnt)::BIGINT AS cnt FROM spots GROUP BY ALL", "spots"))
def count_image(spark, sf_dir):
    return sp.count_image(bind.spots(spark, sf_dir))


@query("count_image_byte", with_ctes("SELECT slice, x, y, value FROM image", "image"))
def count_image_byte(spark, sf_dir):
    path = fresh_path(spark, "image")
    tables.write_image(bind.image(spark, sf_dir), path)
    return spark.read.schema("slice string, x int, y int, value short").parquet(path).select(
        "slice", "x", "y", F.col("value").cast("int").alias("value")
    )


@query(
    "count_image_dense",
    with_ctes(
        """SELECT slice, g.x, g.y, coalesce(i.cnt, 0) AS cnt
           FROM (SELECT slice, x, unnest(range(y0, y1 + 1)) AS y FROM
                  (SELECT slice, y0, y1, unnest(range(x0, x1 + 1)) AS x FROM
                    (SELECT slice, min(x) x0, max(x) x1, min(y) y0, max(y) y1 FROM spots GROUP BY slice))) g
           LEFT JOIN (SELECT slice, x, y, sum(cnt)::BIGINT AS cnt FROM spots GROUP BY ALL) i USING (slice, x, y)""",
        "spots",
    ),
)
def count_image_dense(spark, sf_dir):
    return sp.count_image_dense(bind.spots(spark, sf_dir))


@query(
    "rebase_spots",
    with_ctes("SELECT slice, gene, x - min_x AS x, y - min_y AS y, cnt FROM spots JOIN origin USING (slice)", "spots", "origin"),
)
def rebase_spots(spark, sf_dir):
    return sp.rebase_spots(bind.spots(spark, sf_dir))


@query(
    "fill_gene",
    with_ctes("SELECT slice, coalesce(gene, 'CG5842') AS gene, sum(cnt)::BIGINT AS cnt, count(*) AS n FROM spots GROUP BY 1, 2", "spots"),
)
def fill_gene(spark, sf_dir):
    return sp.fill_gene(bind.spots(spark, sf_dir)).groupBy("slice", "gene").agg(
        F.sum("cnt").alias("cnt"), F.count("*").alias("n")
    )


@query(
    "prepare_spots",
    with_ctes(
        """SELECT slice, coalesce(gene, 'CG5842') AS gene, x - min(x) OVER w AS x, y - min(y) OVER w AS y, cnt
           FROM spots SEMI JOIN (SELECT * FROM mask WHERE value > 0) m USING (slice, x, y)
           WINDOW w AS (PARTITION BY slice)""",
        "spots", "mask",
    ),
)
def prepare_spots(spark, sf_dir):
    return sp.prepare_spots(bind.spots(spark, sf_dir), bind.mask(spark, sf_dir))[0]


@query(
    "parse_slice_name",
    with_ctes(
        """SELECT image, project, chip, split_part(project, '_', 1) AS stage,
             regexp_replace(project, '_S\\d+(_.*)?$', '') AS stack,
             CAST(regexp_extract(project, '_S(\\d+)(_|$)', 1) AS INTEGER) AS slice_no FROM parsed""",
        "parsed",
    ),
)
def parse_slice_name(spark, sf_dir):
    return names.parse_slice_name(bind.images(spark, sf_dir))


@query(
    "prefix_lookup",
    with_ctes(
        """SELECT image, chip, matched, path FROM parsed LEFT JOIN (
             SELECT chip, arg_max(prefix, n) AS matched, arg_max(path, n) AS path FROM (
               SELECT chip, n, array_to_string(string_split(chip, '_')[1:n], '_') AS prefix FROM (
                 SELECT chip, unnest(range(1, len(string_split(chip, '_')) + 1)) AS n
                 FROM (SELECT DISTINCT chip FROM parsed))) JOIN catalog ON key = prefix GROUP BY chip) USING (chip)""",
        "parsed", "catalog",
    ),
)
def prefix_lookup(spark, sf_dir):
    images = names.parse_slice_name(bind.images(spark, sf_dir)).select("image", "chip")
    catalog = materialise(names.file_catalog(bind.files(spark, sf_dir)), "catalog")
    return names.prefix_lookup(images, catalog).select("image", "chip", "matched", "path")


@query(
    "slice_z",
    with_ctes(
        "SELECT slice, cell, round(x, 6) AS x, round(y, 6) AS y, CAST(regexp_extract(slice, '_S(\\d+)', 1) AS INTEGER) * 14 AS z FROM props",
        "props",
    ),
)
def slice_z(spark, sf_dir):
    cells = sp.cell_props(bind.labels(spark, sf_dir)).select("slice", "cell", "x", "y")
    return r6(sp.add_z(cells), "x", "y")


@query("slice_index", with_ctes("SELECT slice, slice_idx FROM slice_idx", "slice_idx"))
def slice_index(spark, sf_dir):
    return sp.slice_index(bind.spots(spark, sf_dir))


@query(
    "gene_file_key",
    with_ctes("SELECT DISTINCT gene, replace(gene, ':', '_') AS file_key FROM spots WHERE gene IS NOT NULL", "spots"),
)
def gene_file_key(spark, sf_dir):
    return sp.gene_keys(bind.spots(spark, sf_dir))


@query(
    "nan_check",
    """SELECT vec_id, pos, v IS NULL AS is_missing FROM (
         SELECT vec_id, i - 1 AS pos, CASE WHEN e[i] < -0.2::DOUBLE THEN 'NaN'::DOUBLE
           WHEN e[i] > 0.3::DOUBLE THEN NULL ELSE e[i] END AS v
         FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, unnest(range(1, len(embedding) + 1)) AS i
               FROM embeddings)) WHERE v IS NULL OR isnan(v)""",
)
def nan_check(spark, sf_dir):
    values = bind.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("pos", "e")
    ).select(
        "vec_id", "pos",
        F.expr("CASE WHEN e < -0.2D THEN double('NaN') WHEN e > 0.3D THEN NULL ELSE e END AS value"),
    )
    return qc.nan_check(values).select("vec_id", "pos", F.col("value").isNull().alias("is_missing"))


# --- spots to cells --------------------------------------------------------------------------


@query(
    "crop_spots",
    with_ctes("SELECT * FROM spots SEMI JOIN (SELECT * FROM mask WHERE value > 0) m USING (slice, x, y)", "spots", "mask"),
)
def crop_spots(spark, sf_dir):
    return sp.crop_spots(bind.spots(spark, sf_dir), bind.mask(spark, sf_dir))


@query(
    "bin_spots",
    with_ctes(
        """SELECT slice, CAST(floor(x / 20) AS INTEGER) AS bx, CAST(floor(y / 20) AS INTEGER) AS "by",
             (floor(x / 20) + 0.5::DOUBLE) * 20 AS x, (floor(y / 20) + 0.5::DOUBLE) * 20 AS y, gene, sum(cnt)::BIGINT AS cnt
           FROM clean GROUP BY slice, floor(clean.x / 20), floor(clean.y / 20), gene""",
        "clean",
    ),
)
def bin_spots(spark, sf_dir):
    return sp.bin_spots(bind.clean(spark, sf_dir), 20)


@query(
    "bin_stats",
    with_ctes(
        """SELECT slice, bx, "by", count(*) AS n_genes, sum(cnt)::BIGINT AS n_counts,
             CAST(sum(CASE WHEN gene LIKE 'mt:%' THEN cnt ELSE 0 END) AS DOUBLE) / sum(cnt)::BIGINT AS p_mito
           FROM (SELECT slice, CAST(floor(x / 20) AS INTEGER) AS bx, CAST(floor(y / 20) AS INTEGER) AS "by", gene,
                   sum(cnt)::BIGINT AS cnt FROM clean GROUP BY ALL) GROUP BY ALL""",
        "clean",
    ),
)
def bin_stats(spark, sf_dir):
    """Per slice and bin: genes, counts, mitochondrial share (the flagship query)."""
    binned = sp.bin_spots(bind.clean(spark, sf_dir), 20).select(
        "slice", F.struct("bx", "by").alias("cell"), "gene", "cnt"
    )
    return qc.basic_stats(binned).select(
        "slice", "cell.bx", "cell.by", "n_genes", "n_counts", "p_mito"
    )


@query(
    "label_long",
    with_ctes(
        "SELECT slice, x - 100 AS x, y - 200 AS y, label FROM label_px WHERE label <> 0", "label_px"
    ),
)
def label_long(spark, sf_dir):
    return sp.label_long(bind.raster(spark, sf_dir))


@query(
    "cellbin_counts",
    with_ctes(
        """SELECT slice, label AS cell, gene, sum(cnt)::BIGINT AS cnt FROM spots JOIN label_px USING (slice, x, y)
           WHERE label <> 0 GROUP BY slice, label, gene""",
        "spots", "label_px",
    ),
)
def cellbin_counts(spark, sf_dir):
    return sp.cellbin_counts(bind.spots(spark, sf_dir), bind.labels(spark, sf_dir))


@query(
    "cell_props",
    with_ctes("SELECT * REPLACE (round(x, 6) AS x, round(y, 6) AS y) FROM props", "props"),
)
def cell_props(spark, sf_dir):
    return r6(sp.cell_props(bind.labels(spark, sf_dir)), "x", "y")


@query(
    "param_join",
    with_ctes("SELECT p.*, cell, area FROM props JOIN params p USING (slice)", "props", "params"),
)
def param_join(spark, sf_dir):
    cells = sp.cell_props(bind.labels(spark, sf_dir)).select("slice", "cell", "area")
    return sp.param_join(cells, materialise(bind.params(spark, sf_dir), "params"))


@query(
    "center_distance",
    with_ctes(
        """SELECT slice, cell, round(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)), 6) AS distance
           FROM props JOIN (SELECT slice, avg(x) AS cx, avg(y) AS cy FROM props GROUP BY slice) USING (slice)""",
        "props",
    ),
)
def center_distance(spark, sf_dir):
    cells = sp.cell_props(bind.labels(spark, sf_dir)).select("slice", "cell", "x", "y")
    return r6(qc.center_distance(cells), "distance").drop("x", "y")


# --- quality and normalisation ---------------------------------------------------------------


@query("basic_stats", with_ctes("SELECT * FROM stats", "stats"))
def basic_stats(spark, sf_dir):
    return qc.basic_stats(bind.counts(spark, sf_dir))


@query("qc_cells", with_ctes("SELECT * FROM good_cells", "good_cells"))
def qc_cells(spark, sf_dir):
    stats = qc.basic_stats(bind.counts(spark, sf_dir))
    return qc.qc_cells(stats, bind.cells(spark, sf_dir))


@query("qc_genes", with_ctes("SELECT * FROM good_genes", "good_genes"))
def qc_genes(spark, sf_dir):
    counts = materialise(bind.counts(spark, sf_dir), "counts")
    cells = materialise(qc.qc_cells(qc.basic_stats(counts), bind.cells(spark, sf_dir)).select("slice", "cell"), "cells")
    return qc.qc_genes(counts, cells)


_BOX = """SELECT slice, '{0}' AS phase, '{1}' AS metric, round(min({1}), 10) AS low,
  round(quantile_cont({1}, 0.25), 10) AS q1, round(quantile_cont({1}, 0.5), 10) AS median,
  round(quantile_cont({1}, 0.75), 10) AS q3, round(max({1}), 10) AS high, round(avg({1}), 10) AS mean
  FROM (SELECT slice, CAST({1} AS DOUBLE) AS {1} FROM {2}) GROUP BY slice"""


@query(
    "qc_box",
    with_ctes(
        " UNION ALL ".join(
            _BOX.format(phase, metric, src)
            for phase, src in (("before", "stats"), ("after", "kept_stats"))
            for metric in ("n_genes", "n_counts", "p_mito")
        ),
        "stats", "kept_stats",
    ),
)
def qc_box(spark, sf_dir):
    counts = materialise(bind.counts(spark, sf_dir), "counts")
    kept = qc.qc_filter(counts, bind.cells(spark, sf_dir))
    cols = ["slice", "cell", "n_genes", "n_counts", "p_mito"]
    box = qc.qc_box(qc.basic_stats(counts).select(*cols), qc.basic_stats(kept).select(*cols))
    return r6(box, "low", "q1", "median", "q3", "high", "mean", digits=10)


@query(
    "qc_summary",
    with_ctes(
        """SELECT slice, count(*) AS n_cells, round(avg(area), 6) AS mean_area, median(area) AS median_area,
             round(avg(n_genes), 6) AS mean_n_genes, median(n_genes) AS median_n_genes,
             round(avg(n_counts), 6) AS mean_n_counts, median(n_counts) AS median_n_counts,
             sum(n_counts)::BIGINT AS total_counts
           FROM (SELECT slice, cell, area, coalesce(n_genes, 0) AS n_genes, coalesce(n_counts, 0) AS n_counts
                 FROM props LEFT JOIN (SELECT slice, cell, count(DISTINCT gene) AS n_genes, sum(cnt)::BIGINT AS n_counts
                   FROM (SELECT slice, label AS cell, gene, cnt FROM filled JOIN label_px USING (slice, x, y))
                   GROUP BY slice, cell) USING (slice, cell)) GROUP BY slice""",
        "props", "spots",
        extra={"filled": "SELECT slice, coalesce(gene, 'CG5842') AS gene, x, y, cnt FROM spots"},
    ),
)
def qc_summary(spark, sf_dir):
    labels = materialise(bind.labels(spark, sf_dir), "labels")
    counts = sp.cellbin_counts(sp.fill_gene(bind.spots(spark, sf_dir)), labels)
    summary = qc.qc_summary(qc.basic_stats(counts), sp.cell_props(labels))
    return r6(summary, "mean_area", "mean_n_genes", "mean_n_counts")


RESID_SQL = """SELECT g.slice, c.cell, g.gene, coalesce(k.cnt, 0) AS cnt,
    least(greatest((coalesce(k.cnt, 0) - c.r * g.s / t.t) / sqrt(c.r * g.s / t.t + (c.r * g.s / t.t) ** 2 / 100.0::DOUBLE),
  -sqrt(t.n)), sqrt(t.n)) AS resid
  FROM (SELECT slice, gene, sum(cnt)::DOUBLE AS s FROM kept GROUP BY ALL) g
  JOIN (SELECT slice, cell, sum(cnt)::DOUBLE AS r FROM kept GROUP BY ALL) c USING (slice)
  JOIN (SELECT slice, sum(cnt)::DOUBLE AS t, count(DISTINCT cell) AS n FROM kept GROUP BY ALL) t USING (slice)
  LEFT JOIN kept k ON k.slice = g.slice AND k.cell = c.cell AND k.gene = g.gene"""
_RESID = {"resid_tab": RESID_SQL}


@query(
    "pearson_resid",
    with_ctes(f"SELECT slice, cell, gene, cnt, {rd('resid')} AS resid FROM resid_tab", "kept", extra=_RESID),
)
def pearson_resid(spark, sf_dir):
    counts = materialise(bind.counts(spark, sf_dir), "counts")
    return r6(normalize.pearson_resid(qc.qc_filter(counts, bind.cells(spark, sf_dir))), "resid")


@query(
    "map_counts",
    with_ctes(
        f"SELECT slice, cell, gene, {rd('resid')} AS resid, coalesce(c.cnt, 0) AS raw_cnt FROM resid_tab LEFT JOIN counts c USING (slice, cell, gene)",
        "kept", extra=_RESID,
    ),
)
def map_counts(spark, sf_dir):
    counts = materialise(bind.counts(spark, sf_dir), "counts")
    norm = normalize.pearson_resid(qc.qc_filter(counts, bind.cells(spark, sf_dir))).drop("cnt")
    return r6(normalize.map_counts(norm, counts), "resid")


@query(
    "integrate",
    with_ctes(
        """SELECT slice, gene, count(DISTINCT cell) AS n_cells, sum(cnt)::BIGINT AS cnt, count(area) AS with_area FROM (
             SELECT slice, cell, gene, cnt, NULL AS area FROM counts
             UNION ALL SELECT slice || '_cellbin', label, gene, cnt, area FROM
               (SELECT slice, label, gene, sum(cnt)::BIGINT AS cnt FROM spots JOIN label_px USING (slice, x, y)
                WHERE label <> 0 GROUP BY ALL) JOIN props p USING (slice) WHERE p.cell = label)
           GROUP BY slice, gene""",
        "counts", "props", "spots",
    ),
)
def integrate(spark, sf_dir):
    labels = materialise(bind.labels(spark, sf_dir), "labels")
    area = sp.cell_props(labels).select("slice", "cell", "area")
    fine = sp.cellbin_counts(bind.spots(spark, sf_dir), labels).join(area, ["slice", "cell"])
    stacked = normalize.integrate(
        bind.counts(spark, sf_dir), fine.withColumn("slice", F.concat("slice", F.lit("_cellbin")))
    )
    return stacked.groupBy("slice", "gene").agg(
        F.countDistinct("cell").alias("n_cells"), F.sum("cnt").alias("cnt"), F.count("area").alias("with_area")
    )


# --- pixels ----------------------------------------------------------------------------------


@query(
    "expand_labels",
    with_ctes(
        """SELECT slice, x, y, label FROM label_px WHERE label <> 0
           UNION ALL SELECT b.slice, b.x, b.y, coalesce(n.label, 0) FROM (SELECT * FROM label_px WHERE label = 0) b
           LEFT JOIN (SELECT * FROM (
             SELECT b.slice, b.x, b.y, l.label, row_number() OVER (PARTITION BY b.slice, b.x, b.y
               ORDER BY (b.x - l.x) ** 2 + (b.y - l.y) ** 2, l.label) AS rn
             FROM (SELECT * FROM label_px WHERE label = 0) b JOIN (SELECT *, unnest(range(-5, 6)) AS dx FROM label_px WHERE label <> 0) l
               ON l.slice = b.slice AND l.x + l.dx = b.x AND abs(l.y - b.y) <= 5
             WHERE (b.x - l.x) ** 2 + (b.y - l.y) ** 2 <= 25) WHERE rn = 1) n USING (slice, x, y)""",
        "label_px",
    ),
)
def expand_labels(spark, sf_dir):
    return pixels.expand_labels(bind.labels(spark, sf_dir), 5)


def _ring_sql(cap: int) -> dict[str, str]:
    """Rings d2 = 1, 2, 4 of a growth with distance 2."""
    parts = {
        "near": """SELECT b.slice, b.x, b.y, l.label, min((b.x - l.x) ** 2 + (b.y - l.y) ** 2) AS d2
          FROM label_px b JOIN (SELECT *, unnest(range(-2, 3)) AS dx FROM label_px WHERE label <> 0) l
            ON l.slice = b.slice AND l.x + l.dx = b.x AND abs(l.y - b.y) <= 2
          WHERE b.label = 0 GROUP BY ALL""",
        "have0": "SELECT * FROM label_px WHERE label <> 0",
    }
    for step, ring in enumerate((1, 2, 4)):
        parts[f"have{step + 1}"] = f"""SELECT * FROM have{step} UNION ALL
          SELECT slice, x, y, min(label) FROM near
          SEMI JOIN (SELECT slice, label FROM have{step} GROUP BY ALL HAVING count(*) < {cap}) g USING (slice, label)
          ANTI JOIN have{step} h USING (slice, x, y) WHERE d2 = {ring} GROUP BY slice, x, y"""
    return parts


@query(
    "expand_labels_capped",
    with_ctes(
        """SELECT slice, x, y, label FROM have3 UNION ALL
           SELECT slice, x, y, 0 FROM label_px p ANTI JOIN have3 h USING (slice, x, y)""",
        "label_px",
        extra=_ring_sql(24),
    ),
)
def expand_labels_capped(spark, sf_dir):
    return pixels.expand_labels(bind.labels(spark, sf_dir), 2, max_area=24)


_HIST = {
    "hist": "SELECT slice, value AS level, count(*) AS n FROM image GROUP BY ALL",
    "pre": """SELECT slice, level, sum(n) OVER u AS w, sum(level * n) OVER u AS s,
        sum(n) OVER (PARTITION BY slice) AS wt, sum(level * n) OVER (PARTITION BY slice) AS st
      FROM hist WINDOW u AS (PARTITION BY slice ORDER BY level)""",
    "cut2": """SELECT slice, 2 AS otsu_class, 0 AS otsu_index, level AS cut FROM (
        SELECT *, row_number() OVER (PARTITION BY slice ORDER BY
          round(w::DOUBLE * (wt - w) * (s / w::DOUBLE - (st - s) / (wt - w)::DOUBLE) ** 2 / wt / wt, 9) DESC, level) AS rn
        FROM pre WHERE w < wt) WHERE rn = 1""",
    "cut3": """SELECT slice, 3 AS otsu_class, i AS otsu_index, CASE i WHEN 0 THEN t1 ELSE t2 END AS cut FROM (
        SELECT a.slice, a.level AS t1, b.level AS t2, row_number() OVER (PARTITION BY a.slice ORDER BY
          round((a.s::DOUBLE ** 2 / a.w + (b.s - a.s)::DOUBLE ** 2 / (b.w - a.w)
            + (b.st - b.s)::DOUBLE ** 2 / (b.wt - b.w)) / b.wt, 9) DESC, a.level, b.level) AS rn
        FROM pre a JOIN pre b ON a.slice = b.slice AND a.level < b.level WHERE b.w < b.wt),
        (SELECT unnest([0, 1]) AS i) WHERE rn = 1""",
}


@query(
    "otsu_cut",
    with_ctes(
        "SELECT * FROM cut2 UNION ALL SELECT * FROM cut3", "image", extra=_HIST
    ),
)
def otsu_cut(spark, sf_dir):
    image = materialise(bind.image(spark, sf_dir), "image")
    two, three = (pixels.otsu_cuts(image, c).withColumn("otsu_class", F.lit(c)) for c in (2, 3))
    return two.unionByName(three)


_FG = _HIST | {
    "fg": """SELECT image.slice, x, y FROM image JOIN params USING (slice)
      JOIN (SELECT * FROM cut2 UNION ALL SELECT * FROM cut3) c USING (slice, otsu_class, otsu_index)
      WHERE value > cut""",
    "node": """SELECT slice, x, y, CAST(x * (max(y) OVER (PARTITION BY slice) + 1) + y AS BIGINT) AS id FROM fg""",
    "reach": """SELECT slice, x, y, id AS src FROM node UNION
      SELECT n.slice, n.x, n.y, r.src FROM reach r JOIN (
          SELECT slice, x + d[1] AS fx, y + d[2] AS fy, x, y FROM
            (SELECT *, unnest([[0, 1], [0, -1], [1, 0], [-1, 0]]) AS d FROM node)) n
        ON n.slice = r.slice AND n.fx = r.x AND n.fy = r.y""",
    "comp": "SELECT slice, x, y, min(src) AS label FROM reach GROUP BY ALL",
}


@query(
    "label_components",
    with_ctes("SELECT slice, x, y, label FROM comp", "image", "params", extra=_FG, recursive=True),
)
def label_components(spark, sf_dir):
    image = materialise(bind.image(spark, sf_dir), "image")
    return pixels.label_components(pixels.foreground(image, bind.params(spark, sf_dir)))


@query(
    "segment_cells",
    with_ctes(
        "SELECT image.slice, image.x, image.y, coalesce(label + 1, 0) AS label FROM image LEFT JOIN comp USING (slice, x, y)",
        "image", "params", extra=_FG, recursive=True,
    ),
)
def segment_cells(spark, sf_dir):
    image = materialise(bind.image(spark, sf_dir), "image")
    return pixels.segment_cells(image, bind.params(spark, sf_dir))


@query(
    "pixel_depths",
    with_ctes(
        "SELECT slice, x, y, max(d) AS depth FROM layers GROUP BY ALL", "image", "params",
        extra={n: _FG[n] for n in [*_HIST, "fg"]} | {
            "layers": """SELECT slice, x, y, 1 AS d FROM fg UNION ALL
              SELECT l.slice, l.x, l.y, l.d + 1 FROM layers l
              SEMI JOIN layers e ON e.slice = l.slice AND e.x = l.x + 1 AND e.y = l.y
              SEMI JOIN layers w ON w.slice = l.slice AND w.x = l.x - 1 AND w.y = l.y
              SEMI JOIN layers n ON n.slice = l.slice AND n.x = l.x AND n.y = l.y + 1
              SEMI JOIN layers s ON s.slice = l.slice AND s.x = l.x AND s.y = l.y - 1""",
        },
        recursive=True,
    ),
)
def pixel_depths(spark, sf_dir):
    image = materialise(bind.image(spark, sf_dir), "image")
    return touching.pixel_depths(pixels.foreground(image, bind.params(spark, sf_dir)))


@query("split_touching")
def split_touching(spark, sf_dir):
    """Touching cells apart, next to the component that each lies in."""
    image = materialise(bind.image(spark, sf_dir), "image")
    bright = materialise(pixels.foreground(image, bind.params(spark, sf_dir)), "bright")
    whole = pixels.label_components(bright).withColumnRenamed("label", "component")
    return touching.split_touching(bright).join(whole, ["slice", "x", "y"])


@query(
    "tile_cdf",
    with_ctes(
        """SELECT slice, x, y, tiled.level, CAST(floor(round(cum * 255 / total, 6)) AS INTEGER) AS value FROM tiled
           JOIN (SELECT *, sum(kept) OVER (PARTITION BY slice, tx, ty ORDER BY level)
                   + (total - sum(kept) OVER (PARTITION BY slice, tx, ty)) * (level + 1) / 256 AS cum
                 FROM (SELECT *, least(n::DOUBLE, total * (7 / 256::DOUBLE)) AS kept FROM
                   (SELECT *, sum(n) OVER (PARTITION BY slice, tx, ty) AS total FROM
                     (SELECT slice, tx, ty, level, count(*) AS n FROM tiled GROUP BY ALL))))
             h USING (slice, tx, ty, level)""",
        "image",
        extra={
            "tiled": """SELECT slice, x, y, value AS level, CAST(floor(x * 10 / (mx + 1)) AS INTEGER) AS tx,
              CAST(floor(y * 10 / (my + 1)) AS INTEGER) AS ty
              FROM image JOIN (SELECT slice, max(x) AS mx, max(y) AS my FROM image GROUP BY slice) USING (slice)"""
        },
    ),
)
def tile_cdf(spark, sf_dir):
    return pixels.tile_cdf(materialise(bind.image(spark, sf_dir), "image"))


# --- file round trips ------------------------------------------------------------------------


@query(
    "params_file",
    with_ctes("SELECT stage, slice, dilation_distance, amount, block_size, radius, otsu_class, otsu_index FROM params", "params"),
)
def params_file(spark, sf_dir):
    path = fresh_path(spark, "params")
    tables.write_csv(bind.params(spark, sf_dir), path)
    return tables.scan_params(spark, path)


@query("labels_file", with_ctes("SELECT slice, x, y, label FROM label_px", "label_px"))
def labels_file(spark, sf_dir):
    path = fresh_path(spark, "labels")
    tables.write_labels(bind.labels(spark, sf_dir), path)
    return tables.scan_labels(spark, path)


@query("gene_map_file", with_ctes("SELECT symbol, gene_id FROM gene_map", "gene_map"))
def gene_map_file(spark, sf_dir):
    path = fresh_path(spark, "gene-map")
    bind.gene_map(spark, sf_dir).select("symbol", "gene_id").write.csv(path, sep="\t", header=True)
    return tables.scan_gene_map(spark, path)


@query("tissue_map_file", with_ctes("SELECT gene_id, stage, tissue FROM tissue_map", "tissue_map"))
def tissue_map_file(spark, sf_dir):
    path = fresh_path(spark, "tissue-map")
    tables.write_csv(bind.tissue_map(spark, sf_dir).select("gene_id", "stage", "tissue"), path)
    return tables.scan_tissue_map(spark, path)


# --- outlines and local brightness -----------------------------------------------------------


@query(
    "outline_crop",
    with_ctes(
        """SELECT s.slice, gene, s.x, s.y, cnt FROM spots s SEMI JOIN (
             SELECT slice, px, py FROM hit GROUP BY slice, px, py HAVING sum(crossed) % 2 = 1 OR bool_or(on_edge)) i
           ON s.slice = i.slice AND s.x = px AND s.y = py""",
        "pixels", "outlines",
        extra={
            "sides": """SELECT slice, x AS x1, y AS y1, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2,
              coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2 FROM outlines WINDOW w AS (PARTITION BY slice, ring ORDER BY seq)""",
            "hit": """SELECT p.slice, p.x AS px, p.y AS py,
              CASE WHEN (y1 > p.y) <> (y2 > p.y) AND p.x < x1 + (p.y - y1) * (x2 - x1)::DOUBLE / (y2 - y1) THEN 1 ELSE 0 END AS crossed,
              (x2 - x1) * (p.y - y1) = (y2 - y1) * (p.x - x1) AND p.x BETWEEN least(x1, x2) AND greatest(x1, x2)
                AND p.y BETWEEN least(y1, y2) AND greatest(y1, y2) AS on_edge
              FROM pixels p JOIN sides USING (slice)""",
        },
    ),
)
def outline_crop(spark, sf_dir):
    return outline.crop_to_outline(bind.spots(spark, sf_dir), bind.outlines(spark, sf_dir))


def _box(source: str, reach: str, result: str) -> str:
    """``result`` over the pixels of ``source`` at most ``reach`` columns and rows away."""
    return f"""SELECT a.slice, a.x, a.y, {result} AS value FROM {source} a JOIN params p USING (slice)
      JOIN (SELECT slice, x, y, value, unnest(range(-8, 9)) AS dx FROM {source}) b
        ON b.slice = a.slice AND b.x + dx = a.x AND abs(dx) <= {reach} AND abs(b.y - a.y) <= {reach} GROUP BY a.slice, a.x, a.y"""


_LOCAL = {
    "sharp": _box(
        "image", "radius",
        "greatest(least(round(any_value(a.value) + any_value(amount) * (any_value(a.value) - avg(b.value)), 6), 255.0::DOUBLE), 0.0::DOUBLE)",
    ),
    "cutoff": _box("sharp", "block_size // 2", "round(any_value(a.value), 6) > round(avg(b.value), 6)"),
}


@query("sharpen", with_ctes("SELECT slice, x, y, round(value, 6) AS value FROM sharp", "image", "params", extra=_LOCAL))
def sharpen(spark, sf_dir):
    return local.sharpen(bind.image(spark, sf_dir), bind.params(spark, sf_dir))


@query("local_foreground", with_ctes("SELECT slice, x, y FROM cutoff WHERE value", "image", "params", extra=_LOCAL))
def local_foreground(spark, sf_dir):
    params = bind.params(spark, sf_dir)
    return local.local_foreground(local.sharpen(bind.image(spark, sf_dir), params), params)


@query("segment_locally")
def segment_locally(spark, sf_dir):
    """Labels by all parameters of a slice: sharpened, cut, connected and grown."""
    image = materialise(bind.image(spark, sf_dir), "image")
    return local.segment_cells_locally(image, bind.params(spark, sf_dir))
