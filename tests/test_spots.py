"""Hand-computed checks of spots, names, pixels, quality and normalisation."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tissueloom.functions import columns
from tissueloom.operators import names, normalize, pixels, qc, ranking
from tissueloom.operators import spots as sp
from tissueloom.sources import tables
from tissueloom.sources.storage import fresh_path

SPOT = "slice string, gene string, x int, y int, cnt bigint"
LABEL = "slice string, x int, y int, label bigint"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_count_byte(spark):
    df = spark.range(0, 13).select(columns.count_byte(F.col("id")).alias("b")).orderBy("id")
    assert [r.b for r in df.collect()] == [0, 25, 51, 76, 102, 127, 153, 178, 204, 229, 255, 255, 255]


def test_rebase_per_slice_and_negative_bins(spark):
    spots = spark.createDataFrame([("a", "g", 5, 9, 1), ("a", "g", 7, 8, 2), ("b", "h", -3, -7, 1)], SPOT)
    assert rows(sp.rebase_spots(spots)) == [("a", "g", 0, 1, 1), ("a", "g", 2, 0, 2), ("b", "h", 0, 0, 1)]
    assert rows(sp.bin_spots(spots, 2).filter("slice = 'b'").select("bx", "by", "x", "y")) == [(-2, -4, -3.0, -7.0)]


def test_fill_gene_words(spark):
    spots = spark.createDataFrame(
        [("a", g, 0, 0, 1) for g in (None, "", "nan", "NaN", "NA", "CG5842", "Nan", "na")], SPOT
    )
    got = {r.gene: r.n for r in sp.fill_gene(spots).groupBy("gene").agg(F.count("*").alias("n")).collect()}
    assert got == {"CG5842": 6, "Nan": 1, "na": 1}


def test_gzip_tsv_keeps_the_nan_gene(spark):
    spots = spark.createDataFrame([("E1_a_S01", "nan", 1, 2, 3), ("E1_a_S02", None, 4, 5, 6)], SPOT)
    path = fresh_path(spark, "t")
    tables.write_spots(spots, path)
    back = tables.scan_spots(spark, path)
    assert rows(back, "slice") == [("E1_a_S01", "nan", 1, 2, 3), ("E1_a_S02", None, 4, 5, 6)]
    assert {r.gene for r in sp.fill_gene(back).collect()} == {"CG5842"}


def test_slice_from_file_name_and_either_header(spark, tmp_path):
    import gzip

    for name, head in (("E8-10h_a_S01_SS2BL", "MIDCount"), ("E8-10h_a_S02_SS2BL", "MIDCounts")):
        with gzip.open(tmp_path / f"{name}_bin1_final.gem.gz", "wt") as f:
            f.write(f"geneID\tx\ty\t{head}\nnan\t1\t2\t3\n")
    assert rows(tables.scan_spots(spark, str(tmp_path))) == [
        ("E8-10h_a_S01_SS2BL", "nan", 1, 2, 3), ("E8-10h_a_S02_SS2BL", "nan", 1, 2, 3)
    ]


def test_listing_and_catalog(spark, tmp_path):
    for p in ("x/SS1_A.gem.gz", "y/SS1_A.gem.gz", "y/z/SS2.gem.gz"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text("x")  # empty files are not listed
    got = dict(rows(names.file_catalog(tables.list_files(spark, str(tmp_path)))))
    assert set(got) == {"SS1_A", "SS2"} and got["SS1_A"].endswith("y/SS1_A.gem.gz")
    batch = names.file_batch(tables.list_files(spark, str(tmp_path)), 2).collect()
    assert [r.path.split("/")[-2] for r in batch] == ["x", "y"]


def test_names(spark):
    images = spark.createDataFrame(
        [("E8-10h_a_S01_SS200000174BL_A1_x.tif",), ("E8-10h_a_S12.tif",)], "image string"
    )
    got = rows(names.parse_slice_name(images).select("project", "chip", "stage", "stack", "slice_no"), "project")
    assert got == [
        ("E8-10h_a_S01", "SS200000174BL_A1_x", "E8-10h", "E8-10h_a", 1),
        ("E8-10h_a_S12", "", "E8-10h", "E8-10h_a", 12),
    ]
    z = spark.createDataFrame([("E8-10h_a_S12_SS200000174BL",), ("noslice",)], "slice string")
    assert rows(sp.add_z(z), "slice") == [("E8-10h_a_S12_SS200000174BL", 168), ("noslice", None)]


def test_prefix_lookup(spark):
    images = spark.createDataFrame([("a_b_c",), ("a_b",), ("a_x",), ("q_r",)], "chip string")
    catalog = spark.createDataFrame([("a", "p1"), ("a_b", "p2"), ("a_b_c_d", "p3")], "key string, path string")
    assert rows(names.prefix_lookup(images, catalog), "chip") == [
        ("a_b", "a_b", "p2"), ("a_b_c", "a_b", "p2"), ("a_x", "a", "p1"), ("q_r", None, None)
    ]


def test_crop_and_cell_counts_never_add(spark):
    spots = spark.createDataFrame([("a", "g", 0, 0, 2), ("a", "g", 0, 1, 3), ("a", "h", 5, 5, 4)], SPOT)
    mask = spark.createDataFrame([("a", 0, 0, 1), ("a", 0, 1, 0)], "slice string, x int, y int, value int")
    assert rows(sp.crop_spots(spots, mask).select("gene", "cnt")) == [("g", 2)]
    labels = spark.createDataFrame([("a", 0, 0, 7), ("a", 0, 1, 7), ("a", 5, 5, 0)], LABEL)
    assert rows(sp.cellbin_counts(spots, labels)) == [("a", 7, "g", 5)]


def test_raster_rows_to_long(spark):
    raster = spark.createDataFrame([("a", 3, [0, 4, 4]), ("a", 4, [0, 0, 0])], "slice string, x int, labels array<bigint>")
    assert rows(sp.label_long(raster)) == [("a", 3, 1, 4), ("a", 3, 2, 4)]


def _grid(size, seeds):
    return [("a", x, y, seeds.get((x, y), 0)) for x in range(size) for y in range(size)]


def _expand(grid, distance, cap=None):
    """Plain reference for growing labels ring by ring."""
    have = {(x, y): lab for _, x, y, lab in grid if lab}
    start = dict(have)
    near = {}
    for _, x, y, lab in grid:
        if not lab:
            for (sx, sy), sl in start.items():
                d2 = (sx - x) ** 2 + (sy - y) ** 2
                if d2 <= distance**2:
                    key = (x, y, sl)
                    near[key] = min(near.get(key, d2), d2)
    for ring in sorted(set(near.values())):
        area = {}
        for lab in have.values():
            area[lab] = area.get(lab, 0) + 1
        taken = {}
        for (x, y, lab), d2 in near.items():
            if d2 == ring and (x, y) not in have and (cap is None or area[lab] < cap):
                taken[x, y] = min(taken.get((x, y), lab), lab)
        have |= taken
    return sorted(("a", x, y, have.get((x, y), 0)) for _, x, y, _ in grid)


@pytest.mark.parametrize("distance,cap", [(2, None), (5, None), (4, None), (3, 12), (2, 4)])
def test_expand_labels(spark, monkeypatch, distance, cap):
    monkeypatch.setattr(pixels, "TILE_SIDE", 6)  # many tile borders
    rnd = random.Random(3)
    seeds = {(rnd.randrange(14), rnd.randrange(14)): rnd.randrange(1, 6) for _ in range(14)}
    seeds |= {(x, y): 9 for x in range(4, 8) for y in range(4, 8)}
    grid = _grid(14, seeds)
    if distance == 5:  # labels that do not fit the packed form
        grid = [(s, x, y, v * 2**50) for s, x, y, v in grid]
    got = rows(pixels.expand_labels(spark.createDataFrame(grid, LABEL), distance, cap), "slice", "x", "y")
    assert got == _expand(grid, distance, cap)


def test_expand_ties_go_to_the_smaller_label(spark):
    grid = spark.createDataFrame([("a", 0, 0, 5), ("a", 0, 1, 0), ("a", 0, 2, 3)], LABEL)
    assert rows(pixels.expand_labels(grid, 1)) == [("a", 0, 0, 5), ("a", 0, 1, 3), ("a", 0, 2, 3)]


def _components(points):
    left, label = set(points), {}
    # frames that reach below zero are counted from their lowest pixel
    low_x, low_y = (min(0, *(p[i] for p in points)) for i in (0, 1))
    width = max(y for _, y in points) + 1 - low_y
    while left:
        stack, comp = [left.pop()], []
        while stack:
            x, y = stack.pop()
            comp.append((x, y))
            for p in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if p in left:
                    left.remove(p)
                    stack.append(p)
        low = min((x - low_x) * width + y - low_y for x, y in comp)
        label |= dict.fromkeys(comp, low)
    return label


@pytest.mark.parametrize("side", [16, 256])
def test_components_of_noise_a_comb_and_a_spiral(spark, monkeypatch, side):
    monkeypatch.setattr(pixels, "TILE_SIDE", side)
    rnd = random.Random(1)
    noise = {(x, y) for x in range(30) for y in range(30) if rnd.random() < 0.58}
    comb = {(0, y) for y in range(25)} | {(x, y) for x in range(20) for y in range(0, 25, 2)}
    spiral, x, y, size = set(), 0, 0, 24
    for turn in range(24):
        dx, dy = ((0, 1), (1, 0), (0, -1), (-1, 0))[turn % 4]
        for _ in range(max(size - turn, 1)):
            spiral.add((x, y))
            x, y = x + dx, y + dy
    shift = -min(p[0] for p in spiral), -min(p[1] for p in spiral)
    spiral = {(a + shift[0], b + shift[1]) for a, b in spiral}
    far = {(x - 100, y) for x, y in comb}  # tiles at negative rows too
    wide = {(x, y) for x in range(200) for y in range(150) if rnd.random() < 0.6}
    sets = {"noise": noise, "comb": comb, "spiral": spiral, "far": far, "wide": wide}
    df = spark.createDataFrame(
        [(s, *p) for s, pts in sets.items() for p in pts], "slice string, x int, y int"
    )
    got = {(r.slice, r.x, r.y): r.label for r in pixels.label_components(df).collect()}
    want = {(s, *p): lab for s, pts in sets.items() for p, lab in _components(pts).items()}
    assert got == want


def test_otsu_against_exhaustive_search(spark):
    rnd = np.random.default_rng(0)
    levels = np.concatenate([rnd.integers(10, 40, 300), rnd.integers(100, 130, 200), rnd.integers(200, 240, 100)])
    df = spark.createDataFrame(
        [("a", i, 0, int(v)) for i, v in enumerate(levels)], "slice string, x int, y int, value int"
    )

    def spread(cuts):
        parts = np.split(np.sort(levels), np.searchsorted(np.sort(levels), [c + 1 for c in cuts]))
        return sum(len(p) * p.mean() ** 2 for p in parts if len(p))

    one = max(range(10, 239), key=lambda t: (round(spread([t]), 6), -t))
    two = max(itertools.combinations(range(10, 239, 1), 2), key=lambda c: (round(spread(c), 6), -c[0], -c[1]))
    present = sorted(set(levels.tolist()))
    snap = lambda c: max(v for v in present if v <= c)
    assert [r.cut for r in pixels.otsu_cuts(df, 2).collect()] == [snap(one)]
    assert [r.cut for r in pixels.otsu_cuts(df, 3).orderBy("otsu_index").collect()] == [snap(c) for c in two]


def test_stats_of_empty_cells_and_filters(spark):
    counts = spark.createDataFrame(
        [("a", 1, "mt:A", 1), ("a", 1, "g1", 19), ("a", 2, "g1", 0), ("a", 3, "mt:A", 5), ("a", 3, "g2", 5)],
        "slice string, cell bigint, gene string, cnt bigint",
    )
    stats = qc.basic_stats(counts)
    assert rows(stats.select("cell", "n_genes", "n_counts", "p_mito")) == [
        (1, 2, 20, 0.05), (2, 0, 0, None), (3, 2, 10, 0.5)
    ]
    props = spark.createDataFrame([("a", c, 25) for c in (1, 2, 3)], "slice string, cell bigint, area bigint")
    assert [r.cell for r in qc.qc_cells(stats, props, min_genes=2).collect()] == [1]
    kept = qc.qc_filter(counts, props, min_genes=2, min_cells=1)
    assert rows(kept.select("cell", "gene")) == [(1, "g1"), (1, "mt:A")]


@pytest.mark.parametrize("n", [1, 2, 999])
def test_exact_quantiles_with_a_hot_value(spark, n):
    rnd = np.random.default_rng(n)
    data = np.where(rnd.random(n) < 0.4, 7.0, rnd.lognormal(size=n))
    df = spark.createDataFrame([("g", float(v)) for v in data] + [("h", None)], "k string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = ranking.exact_quantiles(df, ["k"], "v", probs, buckets=8).orderBy("prob").collect()
    assert np.allclose([r.quantile for r in got], np.quantile(data, probs))


@pytest.mark.parametrize("buckets", [50, 4096])
def test_exact_quantiles_beside_far_outliers(spark, buckets):
    """Buckets of equal width would hold all but one value in one of them."""
    data = np.r_[np.random.default_rng(1).normal(size=4000), 1e12, -1e300]
    df = spark.createDataFrame([("g", float(v)) for v in data], "k string, v double")
    probs = [0.001, 0.25, 0.5, 0.999]
    got = ranking.exact_quantiles(df, ["k"], "v", probs, buckets=buckets).orderBy("prob").collect()
    assert np.allclose([r.quantile for r in got], np.quantile(data, probs))
    assert ranking.exact_quantiles(df.limit(0), ["k"], "v", probs).count() == 0


def test_draw_threshold_is_a_top_n(spark):
    df = spark.range(500).select(
        F.when(F.col("id") < 400, "hot").otherwise("cold").alias("g"), columns.draw_key(F.col("id"), 3).alias("key")
    )
    cut = {r.g: r for r in ranking.draw_threshold(df, ["g"], "key", F.ceil(F.col("n") * 0.3)).collect()}
    for g, part in df.toPandas().groupby("g"):
        want = math.ceil(len(part) * 0.3)
        assert (part["key"] <= cut[g].cut).sum() == want == cut[g]["take"] and cut[g].n == len(part)


def test_residuals_against_the_closed_form(spark):
    rnd = np.random.default_rng(2)
    x = rnd.poisson(0.4, size=(40, 150))
    data = [("a", c, f"g{g:03d}", int(x[c, g])) for c in range(40) for g in range(150) if x[c, g]]
    df = spark.createDataFrame(data, "slice string, cell bigint, gene string, cnt bigint")
    x = x[:, x.sum(axis=0) > 0]
    mu = x.sum(1, keepdims=True) * x.sum(0, keepdims=True) / x.sum()
    z = np.clip((x - mu) / np.sqrt(mu + mu**2 / 100), -math.sqrt(40), math.sqrt(40))
    got = normalize.pearson_resid(df).orderBy("cell", "gene").toPandas()
    assert len(got) == x.size
    assert np.allclose(got["resid"].to_numpy().reshape(x.shape), z)
    assert (got["cnt"].to_numpy().reshape(x.shape) == x).all()


def test_stacking_keeps_all_rows_and_finds_double_keys(spark):
    a = spark.createDataFrame([("s1", 1, "g", 2)], "slice string, cell bigint, gene string, cnt bigint")
    b = spark.createDataFrame([("s2", 1, "h", 3, 9.0)], "slice string, cell bigint, gene string, cnt bigint, x double")
    both = normalize.integrate(a, b)
    assert rows(both, "slice") == [("s1", 1, "g", 2, None), ("s2", 1, "h", 3, 9.0)]
    assert normalize.check_batches(both).count() == 0
    assert normalize.check_batches(both.union(both)).count() == 2


def test_origin_write_replaces_only_its_slices(spark):
    path = fresh_path(spark, "origin")
    schema = "slice string, min_x int, min_y int"
    for data in ([("a", 1, 2), ("b", 3, 4)], [("b", 5, 6)]):
        tables.write_by(spark.createDataFrame(data, schema), path, "slice")
    back = spark.read.schema(schema).parquet(path).select("slice", "min_x", "min_y")
    assert rows(back, "slice") == [("a", 1, 2), ("b", 5, 6)]


def test_label_file_is_sorted(spark):
    path = fresh_path(spark, "labels")
    data = [("a", x, y, (x * 7 + y) % 5 + 1) for x in range(9) for y in range(9)]
    tables.write_labels(spark.createDataFrame(data, LABEL), path)
    back = spark.read.csv(path, sep="\t", header=True, schema=LABEL)
    assert back.count() == 81
    got = [tuple(r) for r in back.filter("label = 2").collect()]
    assert got == sorted(got)


def test_scratch_tables_can_be_dropped(spark):
    import os

    from tissueloom.sources import storage

    kept = storage.materialise(spark.range(3), "kept")
    assert kept.count() == 3
    folder = storage.scratch_dir(spark).removeprefix("file:")
    assert folder.startswith(storage.shared_dir(spark).removeprefix("file:")) and os.listdir(folder)
    storage.drop_scratch(spark)
    assert not os.path.exists(folder)


def test_lookup_files_and_exports(spark, tmp_path):
    """Parameter, gene and tissue files are read with fixed schemas; one parameter row drives one slice."""
    from tissueloom import api

    (tmp_path / "para.csv").write_text(
        "stage,slice,dilation_distance,amount,block_size,radius,otsu_class,otsu_index\n"
        "E8-10h,E8-10h_a_S01,3,1.5,51,2,3,1\nE8-10h,E8-10h_a_S02,4,2,51,2,2,0\n"
    )
    params = api.scan_params(spark, str(tmp_path / "para.csv"))
    cells = spark.createDataFrame([("E8-10h_a_S01", 1), ("E8-10h_a_S09", 2)], "slice string, cell bigint")
    assert [(r.cell, r.otsu_class, r.otsu_index) for r in api.param_join(cells, params).collect()] == [(1, 3, 1)]
    (tmp_path / "genes.tsv").write_text("symbol\tid\nnan\tFB1\n")
    (tmp_path / "tissues.csv").write_text("gene_id,stage,tissue\nFB1,E8-10h,gut\n")
    markers = spark.createDataFrame([(0, "nan"), (0, "x")], "group int, gene string")
    got = api.gene_to_tissue(
        markers,
        api.scan_gene_map(spark, str(tmp_path / "genes.tsv")),
        api.scan_tissue_map(spark, str(tmp_path / "tissues.csv")),
        ["E8-10h"],
    )
    assert rows(got.select("gene", "gene_id", "tissue")) == [("nan", "FB1", "gut"), ("x", None, None)]
    api.write_csv(got.select("gene", "tissue"), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 2


def test_extra_columns_in_spot_files_are_ignored(spark, tmp_path):
    (tmp_path / "S1_bin1_final.gem.gz").write_bytes(
        __import__("gzip").compress(b"geneID\tx\ty\tMIDCounts\tExonCount\ng\t1\t2\t3\t4\n")
    )
    assert rows(tables.scan_spots(spark, str(tmp_path))) == [("S1", "g", 1, 2, 3)]


def test_residuals_of_zero_sums(spark):
    from tissueloom.operators.normalize import pearson_resid

    rows = [("a", 1, "g", 3), ("a", 1, "h", 0), ("a", 2, "g", 0), ("a", 2, "h", 0), ("b", 1, "g", 0)]
    counts = spark.createDataFrame(rows, "slice string, cell bigint, gene string, cnt bigint")
    got = {(r.slice, r.cell, r.gene): r.resid for r in pearson_resid(counts).collect()}
    assert len(got) == 5 and all(v == 0 for k, v in got.items())


def test_labels_below_zero_are_unique(spark):
    px = spark.createDataFrame([("s", 1, -1), ("s", 0, 9), ("s", -3, 0), ("t", 0, 9)], "slice string, x int, y int")
    got = {tuple(r)[:3]: r.label for r in pixels.label_components(px.withColumn("value", F.lit(1))).collect()}
    # s: x from -3, rows of 11 pixels from y = -1; t: not negative, rows of 10 pixels from 0
    assert got == {("s", 1, -1): 44, ("s", 0, 9): 43, ("s", -3, 0): 1, ("t", 0, 9): 9}


def test_slice_folders_are_text(spark):
    path = fresh_path(spark, "spots")
    spots = spark.createDataFrame([("007", "g", 1, 2, 3)], "slice string, gene string, x int, y int, cnt bigint")
    tables.write_spots(spots, path)
    assert rows(tables.scan_spots(spark, path)) == [("007", "g", 1, 2, 3)]
