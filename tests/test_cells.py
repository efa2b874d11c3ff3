"""Lineage, markers, annotation, registration, communities and components."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tissueloom.functions.stats import student_two_sided
from tissueloom.operators import align, annotate, communities, lineage, markers, neighbors, reduce
from tissueloom.plans import bindings as bind
from tissueloom.sources import tables
from tissueloom.sources.storage import fresh_path

SF = "/root/testdata/sf0.01"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# --- lineage ---------------------------------------------------------------------------------


def test_short_lists_change_nothing(spark):
    """A neighbour list that runs out is extended until every replicate is served."""
    sample = lineage.stratified_sample(bind.sc_cells(spark, SF), share=0.5)
    pre, nex = lineage.pair_pool(sample)
    reps, states = lineage.lineage_reps(pre, nex, replicates=20)
    whole = lineage.lineage_counts(pre, nex, reps, list_length=1000)
    short = lineage.lineage_counts(pre, nex, reps, list_length=4)
    order = [*lineage.PAIR, "rep", "nex_state", "pre_state"]
    assert rows(whole.select(*order, "n")) == rows(short.select(*order, "n"))
    probs = lineage.lineage_probs(whole, states)
    sums = probs.groupBy(*lineage.PAIR, "rep", "nex_state").agg(F.sum("prob").alias("p"))
    assert sums.filter("abs(p - 1) > 1e-9").count() == 0


def test_result_does_not_depend_on_partitions(spark):
    cells = bind.sc_cells(spark, SF)
    results = []
    for parts, data in (("3", cells.repartition(5)), ("8", cells.orderBy(F.desc("cell_id")))):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        median = lineage.lineage_median(lineage.lineage_transitions(data, replicates=5, attempts=20))
        results.append(rows(median))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_each_time_pair_draws_its_own_cells(spark):
    cells = _tiny(spark, [(0, "a", 40), (1, "a", 41), (1, "b", 3), (2, "a", 40)])
    pre, nex = lineage.pair_samples(cells)
    drawn = {}
    for side, df in (("pre", pre), ("nex", nex)):
        for r in df.collect():
            drawn.setdefault((side, r["pre_stage"], r["nex_stage"], r["state"]), set()).add(r["cell_id"])
    assert {k: len(v) for k, v in drawn.items()} == {
        ("pre", 0, 1, "a"): 8, ("pre", 0, 2, "a"): 8, ("pre", 1, 2, "a"): 9, ("pre", 1, 2, "b"): 1,
        ("nex", 0, 1, "a"): 9, ("nex", 0, 1, "b"): 1, ("nex", 0, 2, "a"): 8, ("nex", 1, 2, "a"): 8,
    }
    assert drawn["pre", 0, 1, "a"] != drawn["pre", 0, 2, "a"] and drawn["nex", 0, 2, "a"] != drawn["nex", 1, 2, "a"]


def _tiny(spark, sizes):
    data = [
        (i * 100 + n, "RNA", stage, state, [float(stage), float(n)])
        for i, (stage, state, size) in enumerate(sizes)
        for n in range(size)
    ]
    return spark.createDataFrame(data, "cell_id bigint, assay string, stage int, state string, emb array<double>")


def test_rare_states_are_redrawn_until_served(spark):
    """A draw counts only if the rare state is absent from it; pairs do not wait for each other."""
    cells = _tiny(spark, [(0, "a", 10), (0, "rare", 1), (1, "b", 10)])
    pre, nex = lineage.pair_pool(cells)
    reps, states = lineage.lineage_reps(pre, nex, replicates=20, attempts=4)
    assert [r.idx for r in reps.orderBy("rep").collect()] == list(range(1, 21))
    kept = states.join(reps.select(*lineage.PAIR, "rep"), [*lineage.PAIR, "rep"], "left_semi")
    assert rows(kept.select("state").distinct()) == [("a",)]
    once, _ = lineage.lineage_reps(pre, nex, replicates=20, attempts=2000)
    assert rows(once.select("rep", "cut", "k")) == rows(reps.select("rep", "cut", "k"))


def test_impossible_pairs_are_reported_and_do_not_stop_the_others(spark):
    cells = _tiny(spark, [(0, "rare", 2), (1, "a", 9), (2, "b", 9)])
    pre, nex = lineage.pair_pool(cells)
    prospects = lineage.pair_prospects(pre, nex).select("pre_stage", "nex_stage", "n", "take", "possible")
    assert rows(prospects) == [(0, 1, 11, 9, False), (0, 2, 11, 9, False), (1, 2, 18, 14, True)]
    reps, _ = lineage.lineage_reps(pre, nex, replicates=5)
    assert rows(reps.groupBy("pre_stage", "nex_stage").count()) == [(1, 2, 5)]


@pytest.mark.parametrize("sizes, later", [([3, 3], 0), ([3, 4, 2], 1), ([5, 3], 2), ([2, 2], 9), ([6], 0), ([3, 3, 3], 1)])
def test_prospects_match_all_draws(spark, sizes, later):
    """Brute force over every number of cells that each state can keep."""
    pre = _tiny(spark, [(0, f"s{i}", n) for i, n in enumerate(sizes)])
    pre = pre.select("assay", F.lit(0).alias("pre_stage"), F.lit(1).alias("nex_stage"), "cell_id", "state")
    nex = pre.limit(0) if not later else spark.range(later).select(
        F.lit("RNA").alias("assay"), F.lit(0).alias("pre_stage"), F.lit(1).alias("nex_stage"),
        (F.col("id") + 10_000).alias("cell_id"), F.lit("z").alias("state"))
    for drop in (0.0, 0.2, 0.4, 0.6):
        got = lineage.pair_prospects(pre, nex, drop).first()
        options = [[0, *range(3, n + 1)] for n in sizes] + [range(later + 1)]
        want = any(sum(c) == got["take"] and any(c[:-1]) for c in itertools.product(*options))
        assert got["possible"] == want


def test_k_shrinks_and_stays_small(spark):
    cells = _tiny(spark, [(0, "a", 12), (0, "small", 5), (1, "b", 10)])
    pre, nex = lineage.pair_pool(cells)
    sticky, _ = lineage.lineage_reps(pre, nex, replicates=15, attempts=200)
    free, _ = lineage.lineage_reps(pre, nex, replicates=15, attempts=200, sticky_k=False)
    ks = [r.k for r in sticky.orderBy("rep").collect()]
    assert ks == sorted(ks, reverse=True) and ks[-1] >= 3
    assert all(r.k == min(5, r.smallest) for r in free.collect())


def test_time_pairs_are_all_pairs(spark):
    cells = _tiny(spark, [(s, "a", 1) for s in (4, 1, 9)])
    assert rows(lineage.time_pairs(cells)) == [("RNA", 1, 4), ("RNA", 1, 9), ("RNA", 4, 9)]


def test_missing_state_in_some_replicates(spark):
    """The median goes by name and over the replicates that know both states."""
    data = [("RNA", 0, 1, 1, "n", "p", 0.2), ("RNA", 0, 1, 1, "n", "q", 0.8), ("RNA", 0, 1, 2, "n", "p", 1.0)]
    df = spark.createDataFrame(
        data, "assay string, pre_stage int, nex_stage int, rep int, nex_state string, pre_state string, prob double"
    )
    got = {(r.nex_state, r.pre_state): r.prob for r in lineage.lineage_median(df).collect()}
    assert got == {("n", "p"): 0.6, ("n", "q"): 0.8}
    edges = lineage.lineage_edges(lineage.lineage_median(df), 0.6)
    assert rows(lineage.lineage_ancestor(edges)) == [("RNA", "1:n", "0:q", 0.8)]
    assert rows(lineage.lineage_wide(lineage.lineage_median(df), ["p", "q"])) == [("RNA", 0, 1, "n", 0.6, 0.8)]


def test_ancestor_ties_take_the_smaller_name(spark):
    edges = spark.createDataFrame([("b", "c", 0.5), ("a", "c", 0.5)], "parent string, child string, prob double")
    assert rows(lineage.lineage_ancestor(edges)) == [("c", "a", 0.5)]


def test_edge_file_round_trip(spark):
    data = [("E2-4h:AB/CD progenitors", "E4-6h:x: y", 0.25)]
    path = fresh_path(spark, "edges")
    tables.write_edges(spark.createDataFrame(data, "parent string, child string, prob double"), path)
    assert rows(tables.edge_scan(spark, path)) == [("E2-4h", "AB/CD progenitors", "E4-6h", "x: y", 0.25)]


def test_unmatched_embedding_raises(spark):
    meta, emb = spark.range(3).toDF("cell_id"), spark.range(2).toDF("cell_id")
    with pytest.raises(ValueError):
        lineage.attach_embedding(meta, emb)
    assert lineage.attach_embedding(emb, meta).count() == 2


def test_planted_states_find_themselves(spark):
    rng = np.random.default_rng(0)
    data = [
        (i, "RNA", i % 2, f"s{i % 3}", (rng.normal(size=2) * 0.1 + [5 * (i % 3), 0]).tolist()) for i in range(300)
    ]
    cells = spark.createDataFrame(data, "cell_id bigint, assay string, stage int, state string, emb array<double>")
    median = lineage.lineage_median(lineage.lineage_transitions(cells, replicates=10, share=0.6))
    assert all(r.prob == (1.0 if r.nex_state == r.pre_state else 0.0) for r in median.collect())


# --- markers and annotation ------------------------------------------------------------------


def test_student_tail_known_values():
    t = np.array([0.0, 1.0, 2.0, -2.0, 12.706204736, 40.0, np.nan])
    df = np.array([5.0, 1.0, 10.0, 10.0, 1.0, 3.5, 2.0])
    want = [1.0, 0.5, 0.07338803, 0.07338803, 0.05, None, 1.0]
    got = student_two_sided(t, df)
    for g, w in zip(got, want):
        assert w is None or math.isclose(g, w, rel_tol=1e-6)
    assert 0 < got[5] < 1e-4


def test_welch_by_hand_and_zero_variance(spark):
    values = spark.createDataFrame(
        [(1, "g", 1.0), (2, "g", 3.0), (3, "g", 5.0), (4, "g", 9.0), (1, "c", 2.0), (2, "c", 2.0), (3, "c", 2.0), (4, "c", 2.0)],
        "cell bigint, gene string, value double",
    )
    groups = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1)], "cell bigint, group int")
    got = {(r.group, r.gene): r for r in markers.welch_table(values, groups).collect()}
    first = got[0, "g"]
    assert math.isclose(first.score, (2 - 7) / math.sqrt(2 / 2 + 8 / 2))
    assert math.isclose(first["df"], 25 / (1 + 16))
    assert math.isclose(first.logfc, math.log2((math.expm1(2) + 1e-9) / (math.expm1(7) + 1e-9)))
    assert got[0, "c"].score == 0 and got[0, "c"].pval == 1 and first.padj >= first.pval


def test_moments_far_from_zero(spark):
    """Values near 1e8 with a spread of one: the digits of the spread survive."""
    rng = np.random.default_rng(3)
    x = 1e8 + rng.normal(size=(60, 2)) + np.repeat([0.0, 3.0, 1.0], 20)[:, None]
    x[:, 1] = x[0, 1]  # a constant gene
    values = spark.createDataFrame(
        [(c, f"g{g}", float(x[c, g])) for c in range(60) for g in range(2)], "cell bigint, gene string, value double"
    )
    groups = spark.createDataFrame([(c, c // 20) for c in range(60)], "cell bigint, group int")
    got = {(r.group, r.gene): r for r in markers.welch(markers.group_sums(values, groups)).collect()}
    for g in range(3):
        own, rest = x[g * 20 : g * 20 + 20, 0] - 1e8, np.delete(x[:, 0], slice(g * 20, g * 20 + 20)) - 1e8
        want = (own.mean() - rest.mean()) / math.sqrt(own.var(ddof=1) / 20 + rest.var(ddof=1) / 40)
        assert math.isclose(got[g, "g0"].score, want, rel_tol=1e-6)
        assert got[g, "g1"].score == 0


def test_cells_of_two_slices_stay_apart(spark):
    values = spark.createDataFrame(
        [("a", 1, "g", 1.0), ("a", 2, "g", 1.0), ("b", 1, "g", 9.0), ("b", 2, "g", 9.0)],
        "slice string, cell bigint, gene string, value double",
    )
    groups = values.selectExpr("slice", "cell", "if(slice = 'a', 0, 1) AS `group`")
    assert rows(markers.group_sums(values, groups).select("group", "n", "s1", "m2")) == [(0, 2, 2.0, 0.0), (1, 2, 18.0, 0.0)]


def test_tiny_p_values_are_told_apart(spark):
    """The smaller p wins although both are far below 1e-12, also where p is 0 as a double."""
    data = [(0, "A", 5, -92.1), (0, "B", 9, -34.5), (1, "A", 5, -900.0), (1, "B", 9, -800.0), (2, "B", 9, -3.0), (2, "A", 9, -3.0)]
    table = spark.createDataFrame(data, "group int, tissue string, hits int, log_pval double")
    best = annotate.best_annotation(table.withColumn("pval", F.exp("log_pval")))
    assert rows(best.select("group", "tissue")) == [(0, "A"), (1, "A"), (2, "A")]


def test_absent_values_count_as_zero(spark):
    """A sparse table gives the same test as the dense one."""
    rng = np.random.default_rng(1)
    x = rng.poisson(0.5, size=(20, 6)).astype(float)
    x[:10, 0] = 0  # a gene one group does not have at all
    dense = spark.createDataFrame(
        [(c, f"g{g}", float(x[c, g])) for c in range(20) for g in range(6)], "cell bigint, gene string, value double"
    )
    groups = spark.createDataFrame([(c, c // 10) for c in range(20)], "cell bigint, group int")
    cols = ["group", "gene", "score", "df"]
    a = markers.welch_table(dense, groups).select(*cols)
    b = markers.welch_table(dense.filter("value <> 0"), groups).select(*cols)
    for left, right in zip(rows(a, "group", "gene"), rows(b, "group", "gene"), strict=True):
        assert left[:2] == right[:2] and np.allclose(left[2:], right[2:])


def test_negative_fold_is_null(spark):
    values = spark.createDataFrame([(1, "g", -1.0), (2, "g", -2.0), (3, "g", 1.0), (4, "g", 2.0)], "cell bigint, gene string, value double")
    groups = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1)], "cell bigint, group int")
    assert all(r.logfc is None for r in markers.welch_table(values, groups).collect())


def test_bh_by_hand(spark):
    df = spark.createDataFrame([("k", t, p) for t, p in zip("abcd", (0.01, 0.04, 0.03, 0.9))], "g string, t string, p double")
    got = [r.padj for r in markers.bh_adjust(df, "p", ["g"], "t").orderBy("t").collect()]
    assert np.allclose(got, [0.04, 0.04 * 4 / 3, 0.04 * 4 / 3, 0.9])


def test_enrichment_by_hand(spark):
    genes = [f"d{i}" for i in range(10)]
    gene_map = spark.createDataFrame([(g, "F" + g) for g in genes], "symbol string, gene_id string")
    tissue = spark.createDataFrame(
        [("F" + g, "0", "t0" if i < 4 else "t1") for i, g in enumerate(genes)] + [("Fd0", "1", "late")],
        "gene_id string, stage string, tissue string",
    )
    picked = spark.createDataFrame([(0, g, 1) for g in ("d0", "d1", "d2", "d9", "unknown")], "group int, gene string, rank int")
    got = {r.tissue: r for r in annotate.enrich(picked, gene_map, tissue, ["0"]).collect()}
    # 3 of 4 drawn hit 4 of 10: (C(4,3) C(6,1) + C(4,4)) / C(10,4) = 25 / 210
    assert math.isclose(got["t0"].pval, 25 / 210) and got["t0"].drawn == 4 and set(got) == {"t0", "t1"}
    best = annotate.annotate(picked, gene_map, tissue, ["0"])
    assert [r.tissue for r in best.collect()] == ["t0"]
    cells = spark.createDataFrame([(1, 0), (2, 5)], "cell bigint, cluster int")
    assert rows(annotate.annotate_cells(cells, best).select("cell", "auto_anno"), "cell") == [(1, "t0"), (2, None)]


# --- registration ----------------------------------------------------------------------------


def test_rigid_fit_recovers_a_turn_far_from_the_origin(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(50, 2)) + 1e6
    turn, shift = 0.7, np.array([12.0, -5.0])
    rot = np.array([[math.cos(turn), -math.sin(turn)], [math.sin(turn), math.cos(turn)]])
    b = a @ rot.T + shift
    pairs = spark.createDataFrame(
        [(1, *map(float, (*p, *q)), float(w)) for p, q, w in zip(a, b, rng.random(50) + 0.1)],
        "slice_idx int, ax double, ay double, bx double, `by` double, w double",
    )
    fit = align.rigid_fit(pairs).first()
    assert math.isclose(fit.theta, turn, abs_tol=1e-8)
    cells = spark.createDataFrame([(1, float(a[0, 0]), float(a[0, 1])), (0, 1.0, 2.0)], "slice_idx int, x double, y double")
    moved = align.apply_transform(cells, align.rigid_fit(pairs)).orderBy("slice_idx").collect()
    assert (moved[0].align_x, moved[0].align_y) == (1.0, 2.0)
    assert np.allclose((moved[1].align_x, moved[1].align_y), b[0], atol=1e-3)


def test_registration_of_noisy_slices(spark):
    """Different points, jitter and unreliable features still give back the turn."""
    rng = np.random.default_rng(5)
    base = np.array([(x, y) for x in range(0, 60, 4) for y in range(0, 40, 4)], float)
    data = []
    for s in range(3):
        t = 0.06 * s
        rot = np.array([[math.cos(t), -math.sin(t)], [math.sin(t), math.cos(t)]])
        for i, p in enumerate(base):
            x, y = rot @ (p + rng.normal(scale=0.1, size=2)) + [2 * s, -s]
            data.append((f"S{s}", s, i, float(x), float(y), (p + rng.normal(scale=0.5, size=2)).tolist()))
    cells = spark.createDataFrame(data, "slice string, slice_idx int, cell bigint, x double, y double, vec array<double>")
    got = {r.slice_idx: r for r in align.register_slices(cells, rounds=4).collect()}
    assert got[0].theta == 0 and got[0].tx == 0
    for s in (1, 2):
        assert math.isclose(got[s].theta, -0.06 * s, abs_tol=0.01)
    moved = align.apply_transform(cells, spark.createDataFrame(list(got.values()))).toPandas()
    still = base[moved.sort_values(["slice_idx", "cell"])["cell"].to_numpy()]
    fit = moved.sort_values(["slice_idx", "cell"])[["align_x", "align_y"]].to_numpy()
    assert np.abs(fit - still).max() < 1.0


def test_spatial_sample_covers_the_slice(spark):
    rng = np.random.default_rng(6)
    pts = np.concatenate([rng.normal(size=(3000, 2)) * 0.5, rng.uniform(-20, 20, size=(300, 2))])
    cells = spark.createDataFrame([("a", i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "slice string, cell bigint, x double, y double")
    got = align.spatial_sample(cells, 500)
    assert got.count() == 500 and got.select("cell").distinct().count() == 500
    assert got.filter("abs(x) > 5 or abs(y) > 5").count() >= 200  # the dense lump does not crowd out the rest


def test_pairing_mismatch_raises(spark):
    a = spark.createDataFrame([("s1",), ("s2",)], "slice string")
    align.check_pairing(a, a)
    with pytest.raises(ValueError):
        align.check_pairing(a, a.limit(1))


# --- communities and components --------------------------------------------------------------


def test_planted_groups_are_found(spark):
    cells = bind.vecs(spark, SF)
    edges = neighbors.symmetric_edges(neighbors.knn_graph(cells, 10, 1))
    found = communities.communities(edges, (1.2, 2.2))
    both = found.join(cells.selectExpr("cell AS node", "label"), "node")
    purity = both.groupBy("resolution", "community", "label").count().groupBy("resolution", "community").agg(
        (F.max("count") / F.sum("count")).alias("p"), F.sum("count").alias("n")
    )
    share = purity.groupBy("resolution").agg((F.sum(F.col("p") * F.col("n")) / F.sum("n")).alias("share"))
    assert all(r.share > 0.9 for r in share.collect())
    sizes = found.groupBy("resolution", "community").count().orderBy("resolution", "community").collect()
    for gamma in (1.2, 2.2):
        counts = [r["count"] for r in sizes if r.resolution == gamma]
        assert counts == sorted(counts, reverse=True)


def test_two_cliques_and_modularity(spark):
    cliques = [(a, b) for base in (0, 5) for a in range(base, base + 5) for b in range(base, base + 5) if a != b]
    pairs = cliques + [(4, 5), (5, 4)]
    edges = spark.createDataFrame([(i, j, 1.0) for i, j in pairs], "i bigint, j bigint, w double")
    found = {r.node: r.community for r in communities.communities(edges, (1.0,)).collect()}
    assert found == {n: int(n > 4) for n in range(10)}
    wide = communities.with_resolutions(edges, (1.0,))
    nodes = spark.createDataFrame([(1.0, n, n // 5, 4.0 + (n in (4, 5))) for n in range(10)], "resolution double, i bigint, c bigint, k double")
    q = communities.modularity(wide, nodes, 42.0).first().q
    assert math.isclose(q, 40 / 42 - 2 * (21 / 42) ** 2)


def test_more_rounds_never_lower_modularity(spark):
    cells = bind.vecs(spark, SF, planted=False)
    edges = neighbors.symmetric_edges(neighbors.knn_graph(cells, 6, 2))
    wide = communities.with_resolutions(edges, (1.0,))
    two_m = wide.count()
    degree = wide.groupBy("i").agg(F.sum("w").alias("k"))
    last = -1.0
    for rounds in (1, 3, 6):
        found = communities.communities(edges, (1.0,), rounds=rounds, levels=1)
        nodes = found.join(degree, found.node == degree.i).selectExpr("resolution", "i", "cast(community AS bigint) AS c", "k")
        q = communities.modularity(wide, nodes, two_m).first().q
        assert q >= last - 1e-9
        last = q
    assert last > 0.05


def test_cluster_and_rank(spark):
    cells = bind.vecs(spark, SF)
    clusters, top = markers.cluster_and_rank(cells, bind.values(spark, SF), (1.2,))
    assert clusters.count() == 500
    assert top.filter("rank = 1").filter("score > 5").count() >= 5


def test_components_match_numpy_on_both_paths(spark):
    x = np.random.default_rng(7).normal(size=(60, 8)) @ np.diag(np.arange(1, 9.0))
    cells = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cell bigint, vec array<double>")
    c = x - x.mean(0)
    _, s, v = np.linalg.svd(c, full_matrices=False)
    for width in (4096, 4):
        found, scores = reduce.fit_pca(cells, k=3, covariance_width=width)
        assert np.allclose(found.share, (s**2 / (s**2).sum())[:3])
        assert np.allclose(np.abs(found.loadings), np.abs(v[:3].T), atol=1e-6)
        got = np.array([r.X_pca for r in scores.orderBy("cell").collect()])
        # a fixed shift of the scores is possible, as components may be applied before centring
        got = got - got.mean(0)
        assert np.allclose(np.abs(got), np.abs(c @ v[:3].T), atol=1e-6)


def test_component_count(spark):
    x = np.random.default_rng(8).normal(size=(200, 5)) * [10, 5, 1, 0.1, 0.1]
    cells = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cell bigint, vec array<double>")
    share = np.linalg.svd(x - x.mean(0), compute_uv=False) ** 2
    want = int(np.argmax(np.cumsum(share / share.sum()) >= 0.9)) + 1
    assert reduce.n_components(cells).first()[0] == want


def test_lineage_files_are_split_by_time_pair(spark, tmp_path):
    data = [("RNA", 0, 1, 1, "n", "p", 0.5), ("RNA", 0, 2, 1, "n", "p", 0.25)]
    df = spark.createDataFrame(
        data, "assay string, pre_stage int, nex_stage int, rep int, nex_state string, pre_state string, prob double"
    )
    tables.write_lineage(df, lineage.lineage_median(df), str(tmp_path))
    back = spark.read.parquet(str(tmp_path / "median" / "pre_stage=0" / "nex_stage=2"))
    assert back.first().prob == 0.25
