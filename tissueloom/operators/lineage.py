"""Which earlier state does each later state come from?  Resampled nearest-neighbour estimate.

Replicates never become a loop or a copy of the data.  Neighbour lists are computed once per
time pair on all sampled cells; a replicate keeps the cells whose seeded hash is below the
replicate's threshold, so a later cell finds its k nearest *kept* earlier cells by walking its
list.  Cells whose list runs out get a longer list, until all are served.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueloom.functions.columns import draw_key
from tissueloom.operators.neighbors import knn_join
from tissueloom.operators.ranking import draw_threshold
from tissueloom.sources.storage import lookup_table, materialise

# Fixed values of the estimate.
SAMPLE_SHARE = 0.2
REPLICATES = 500
DROP_SHARE = 0.2
MIN_CELL = 3
K_NEIGH = 5
MIN_EDGE = 0.2

PAIR = ["assay", "pre_stage", "nex_stage"]


def assay_subset(cells: DataFrame, assay: str) -> DataFrame:
    return cells.filter(F.col("assay") == assay)


def time_pairs(cells: DataFrame) -> DataFrame:
    """Every earlier/later pair of time points of each assay.

    The distinct time points of an assay become one sorted array, and pairs are read off it.
    """
    stages = (
        cells.select("assay", "stage").distinct().groupBy("assay").agg(
            F.sort_array(F.collect_list("stage")).alias("_t")
        )
    )
    first = stages.select("assay", "_t", F.posexplode("_t").alias("_i", "pre_stage"))
    later = F.slice(F.col("_t"), F.col("_i") + 2, F.size("_t"))
    return first.select("assay", "pre_stage", F.explode(later).alias("nex_stage"))


def stratified_sample(
    cells: DataFrame, by=("assay", "stage", "state"), share: float = SAMPLE_SHARE, seed: int = 7
) -> DataFrame:
    """``ceil(share * n)`` cells of every group, without replacement, by seeded hash order."""
    by = list(by)
    keyed = cells.withColumn("_key", draw_key(F.col("cell_id"), seed))
    take = F.ceil(F.round(F.col("n") * F.lit(share), 9))
    cut = lookup_table(draw_threshold(keyed, by, "_key", take).select(*by, "cut"), "cuts")
    return keyed.join(cut, by).filter("_key <= cut").select(*cells.columns)


def check_alignment(meta: DataFrame, emb: DataFrame, key: str = "cell_id") -> DataFrame:
    """Rows of either table and how many lack a partner in the other."""
    sides = meta.select(key, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        emb.select(key, F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    per_cell = sides.groupBy(key).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return per_cell.agg(
        F.sum("a").alias("n_meta"),
        F.sum("b").alias("n_emb"),
        F.count_if(F.col("b") == 0).alias("missing_emb"),
        F.count_if(F.col("a") == 0).alias("missing_meta"),
    )


def attach_embedding(meta: DataFrame, emb: DataFrame, key: str = "cell_id") -> DataFrame:
    """Join embeddings to cells; raises when a cell has none."""
    lonely = meta.join(emb, key, "left_anti").limit(1).count()
    if lonely:
        raise ValueError("cells without an embedding row")
    return meta.join(emb, key)


def pair_pool(sample: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Earlier and later cells of every time pair."""
    sample = sample.filter(F.col("state").isNotNull())
    pairs = materialise(time_pairs(sample), "pairs")
    fields = ["cell_id", "state", "emb"]
    pre = pairs.join(sample.withColumnRenamed("stage", "pre_stage"), ["assay", "pre_stage"])
    nex = pairs.join(sample.withColumnRenamed("stage", "nex_stage"), ["assay", "nex_stage"])
    return pre.select(*PAIR, *fields), nex.select(*PAIR, *fields)


def pair_samples(cells: DataFrame, share: float = SAMPLE_SHARE, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """Earlier and later cells of every time pair, each pair's drawn anew.

    ``ceil(share * n)`` cells of every (pair, stage, state), without replacement, by an order that depends on the pair.
    """
    cells = cells.filter(F.col("state").isNotNull())
    pairs = materialise(time_pairs(cells), "pairs")
    later = pairs.groupBy("assay", "pre_stage").agg(F.collect_set("nex_stage").alias("_others"))
    earlier = pairs.groupBy("assay", "nex_stage").agg(F.collect_set("pre_stage").alias("_others"))
    key = draw_key(F.col("cell_id"), F.col("pre_stage"), F.col("nex_stage"), seed)
    take = F.ceil(F.round(F.col("n") * F.lit(share), 9))
    pools = []
    for own, other, listed in (("pre_stage", "nex_stage", later), ("nex_stage", "pre_stage", earlier)):
        keyed = (
            cells.withColumnRenamed("stage", own).join(listed, ["assay", own])
            .withColumn(other, F.explode("_others")).withColumn("_key", key)
        )
        by = [*PAIR, "state"]
        cut = lookup_table(draw_threshold(keyed, by, "_key", take).select(*by, "cut"), "cuts")
        pools.append(keyed.join(cut, by).filter("_key <= cut").select(*PAIR, "cell_id", "state", "emb"))
    return pools[0], pools[1]


def _attempts(cells: DataFrame, first: int, last: int, seed: int) -> DataFrame:
    rep = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("rep")
    return cells.select("*", rep).withColumn("_key", draw_key(F.col("cell_id"), F.col("rep"), seed))


def pair_prospects(
    pre: DataFrame, nex: DataFrame, drop: float = DROP_SHARE, min_cell: int = MIN_CELL
) -> DataFrame:
    """``PAIR…, n, take, possible``: can any draw of the pair ever be accepted?

    A draw keeps ``take`` of the pair's ``n`` cells; every earlier state must keep no cell or at
    least ``min_cell``, and one state must keep some.  With ``i`` states kept the draw holds at
    least ``i * min_cell`` cells and at most the later cells plus the ``i`` largest states, and
    every number between can be reached.
    """
    states = pre.groupBy(*PAIR, "state").agg(F.count("*").alias("size"))
    later = nex.groupBy(*PAIR).agg(F.count("*").alias("later"))
    whole = states.groupBy(*PAIR).agg(F.sum("size").alias("earlier"))
    total = (
        whole.join(later, PAIR, "left")
        .select(*PAIR, F.coalesce("later", F.lit(0)).alias("later"), "earlier")
        .withColumn("n", F.col("later") + F.col("earlier"))
        .withColumn("take", F.round(F.col("n") * F.lit(1.0 - drop)).cast("long"))
    )
    order = Window.partitionBy(*PAIR).orderBy(F.desc("size"), "state")
    most = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    fits = (
        states.filter(F.col("size") >= min_cell)
        .withColumn("least", F.row_number().over(order) * min_cell)
        .withColumn("most", most)
        .join(total, PAIR)
        .filter((F.col("take") >= F.col("least")) & (F.col("take") <= F.col("most") + F.col("later")))
        .select(*PAIR, F.lit(True).alias("_fits"))
        .distinct()
    )
    return total.join(fits, PAIR, "left").select(
        *PAIR, "n", "take", F.coalesce("_fits", F.lit(False)).alias("possible")
    )


def lineage_reps(
    pre: DataFrame,
    nex: DataFrame,
    replicates: int = REPLICATES,
    drop: float = DROP_SHARE,
    min_cell: int = MIN_CELL,
    k: int = K_NEIGH,
    sticky_k: bool = True,
    seed: int = 7,
    attempts: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Accepted replicates (``PAIR…, rep, cut, k``) and their earlier-state sizes.

    An attempt is dropped when its smallest earlier state has fewer than ``min_cell`` cells;
    ``k`` shrinks to the smallest state size and, with ``sticky_k``, never grows back.  Attempt
    numbers are drawn in batches, the first of ``attempts`` (default: ``replicates``), the next
    ones twice as large and only for the pairs still short, until every pair is served; the
    result does not depend on the batches.  Pairs that can never be served (``pair_prospects``)
    get no replicate.
    """
    ids = ["cell_id", "state"]
    pool = pre.select(*PAIR, *ids).unionByName(nex.select(*PAIR, *ids))
    take = F.round(F.col("n") * F.lit(1.0 - drop))
    order = Window.partitionBy(*PAIR).orderBy("rep")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    smallest = F.min("smallest").over(upto) if sticky_k else F.col("smallest")
    wanted = materialise(
        pair_prospects(pre, nex, drop, min_cell).filter("possible").select(*PAIR), "pairs"
    )
    first, size = 1, attempts or replicates
    cuts, states, short = None, None, wanted
    while True:
        last = first + size - 1
        keyed = _attempts(pool.join(short, PAIR, "left_semi").select(*PAIR, "cell_id"), first, last, seed)
        new_cuts = lookup_table(
            draw_threshold(keyed, [*PAIR, "rep"], "_key", take, prefix=2).select(*PAIR, "rep", "cut"), "cuts"
        )
        early = pre.join(short, PAIR, "left_semi").select(*PAIR, *ids)
        kept = _attempts(early, first, last, seed).join(
            new_cuts, [*PAIR, "rep"]
        ).filter("_key <= cut")
        drawn = materialise(kept.groupBy(*PAIR, "rep", "state").agg(F.count("*").alias("n")), "states")
        cuts = new_cuts if cuts is None else cuts.unionByName(new_cuts)
        states = drawn if states is None else states.unionByName(drawn)
        accepted = (
            states.groupBy(*PAIR, "rep")
            .agg(F.min("n").alias("smallest"))
            .filter(F.col("smallest") >= min_cell)
            .withColumn("idx", F.row_number().over(order))
            .withColumn("k", F.least(F.lit(k), smallest).cast("int"))
            .filter(F.col("idx") <= replicates)
        )
        reps = materialise(accepted.join(cuts, [*PAIR, "rep"]), "reps")
        served = reps.groupBy(*PAIR).count().filter(F.col("count") >= replicates)
        short = materialise(wanted.join(served, PAIR, "left_anti"), "pairs")
        if short.isEmpty():
            return lookup_table(reps, "reps"), states
        first, size = last + 1, 2 * size


def lineage_counts(
    pre: DataFrame, nex: DataFrame, reps: DataFrame, seed: int = 7, list_length: int = 25, **sizes
) -> DataFrame:
    """Neighbour-state counts ``PAIR…, rep, nex_state, pre_state, n`` (non-zero cells only)."""
    todo = nex
    wanted = None  # None: every accepted replicate; else the (cell, replicate) pairs left over
    length, parts = list_length, []
    while True:
        near = knn_join(
            todo, pre, length, by=PAIR, query_id="cell_id", base_id="cell_id", vec="emb",
            carry=["state"], **sizes,
        )
        lists = near.groupBy(*PAIR, F.col("src").alias("cell_id")).agg(
            F.sort_array(F.collect_list(F.struct("rank", F.col("dst").alias("id"), "state"))).alias("near")
        )
        lists = materialise(lists.join(todo.select(*PAIR, "cell_id", F.col("state").alias("nex_state")), [*PAIR, "cell_id"]), "lists")
        walk = lists.join(reps.select(*PAIR, "rep", "cut", "k"), PAIR)
        if wanted is None:
            walk = walk.filter(draw_key(F.col("cell_id"), F.col("rep"), seed) <= F.col("cut"))
        else:
            walk = walk.join(wanted, [*PAIR, "cell_id", "rep"], "left_semi")
        alive = F.expr(f"filter(near, c -> md5(concat_ws('|', c.id, rep, '{seed}')) <= cut)")
        walk = walk.withColumn("alive", F.slice(alive, F.lit(1), F.col("k")))
        served = (F.size("alive") >= F.col("k")) | (F.size("near") < length)
        # a cell whose list ran out leaves one row without an earlier state
        found = F.when(served, F.col("alive.state")).otherwise(F.array(F.lit(None).cast("string")))
        part = materialise(
            walk.select(*PAIR, "rep", "nex_state", F.explode(found).alias("pre_state"))
            .groupBy(*PAIR, "rep", "nex_state", "pre_state")
            .agg(F.count("*").alias("n")),
            "counts",
        )
        parts.append(part.filter("pre_state is not null"))
        if not part.filter("pre_state is null").limit(1).count():
            break
        wanted = materialise(walk.filter(~served).select(*PAIR, "cell_id", "rep"), "short")
        todo = nex.join(wanted.select(*PAIR, "cell_id").distinct(), [*PAIR, "cell_id"], "left_semi")
        length *= 4
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    if len(parts) > 1:
        counts = counts.groupBy(*PAIR, "rep", "nex_state", "pre_state").agg(F.sum("n").alias("n"))
    return counts


def lineage_probs(counts: DataFrame, states: DataFrame) -> DataFrame:
    """Row-normalised counts with a zero for every state pair that met no neighbour."""
    key = [*PAIR, "rep"]
    rows = counts.groupBy(*key, "nex_state").agg(F.sum("n").alias("total"))
    columns = states.groupBy(*key).agg(F.collect_set("state").alias("_pre"))
    grid = rows.join(columns, key).select(
        *key, "nex_state", "total", F.explode("_pre").alias("pre_state")
    )
    filled = grid.join(counts, [*key, "nex_state", "pre_state"], "left").fillna(0, ["n"])
    return filled.select(
        *key, "nex_state", "pre_state", "n", (F.col("n") / F.col("total")).alias("prob")
    )


def lineage_transitions(
    cells: DataFrame,
    replicates: int = REPLICATES,
    share: float = SAMPLE_SHARE,
    drop: float = DROP_SHARE,
    min_cell: int = MIN_CELL,
    k: int = K_NEIGH,
    sticky_k: bool = True,
    seed: int = 7,
    list_length: int = 25,
    attempts: int | None = None,
) -> DataFrame:
    """Sample, resample, find neighbours, normalise: the transition matrix of every replicate."""
    pre, nex = (materialise(t, "pool") for t in pair_samples(cells, share, seed))
    reps, states = lineage_reps(pre, nex, replicates, drop, min_cell, k, sticky_k, seed, attempts)
    accepted = states.join(reps.select(*PAIR, "rep"), [*PAIR, "rep"], "left_semi")
    return lineage_probs(lineage_counts(pre, nex, reps, seed, list_length), accepted)


def lineage_median(transitions: DataFrame) -> DataFrame:
    """Median over the replicates (at most a few hundred values per matrix entry), by state name."""
    return transitions.groupBy(*PAIR, "nex_state", "pre_state").agg(F.median("prob").alias("prob"))


def lineage_edges(median: DataFrame, min_prob: float = MIN_EDGE) -> DataFrame:
    """Edge list ``stage:state -> stage:state`` of the entries that are strong enough."""
    return median.filter(F.round("prob", 12) >= F.lit(min_prob)).select(
        "assay",
        F.concat_ws(":", "pre_stage", "pre_state").alias("parent"),
        F.concat_ws(":", "nex_stage", "nex_state").alias("child"),
        "prob",
    )


def lineage_ancestor(edges: DataFrame) -> DataFrame:
    """Most likely parent of every child; ties go to the smallest name."""
    by = [c for c in edges.columns if c not in ("parent", "child", "prob")]
    key = F.struct(-F.round("prob", 12), F.col("parent"))
    return edges.groupBy(*by, "child").agg(
        F.min_by("parent", key).alias("parent"), F.max("prob").alias("prob")
    )


def lineage_wide(median: DataFrame, states: list[str]) -> DataFrame:
    """Matrix form: one row per later state, one column per earlier state."""
    return (
        median.groupBy(*PAIR, "nex_state").pivot("pre_state", states).agg(F.first("prob"))
    )


def lineage_paths(edges: DataFrame) -> DataFrame:
    """Most likely chain between every two nodes that one connects: ``by…, src, dst, prob, steps, path``.

    ``edges``: ``by…, parent, child, prob`` with ``prob`` above 0 and at most 1 (others are left out); of repeated edges the
    best counts.  A chain's probability is the product along it; ties (12 digits) go to fewer steps, then to the
    smaller path.  Each round lengthens only the chains that the last one found or bettered, and keeps one per pair;
    it ends when none gets better, after as many rounds as the longest best chain has steps.
    """
    by = [c for c in edges.columns if c not in ("parent", "child", "prob")]
    links = edges.filter("prob > 0 AND prob <= 1 AND parent <> child").groupBy(*by, "parent", "child").agg(F.max("prob").alias("step"))
    links = materialise(links, "links")
    key = [*by, "src", "dst"]
    rank = F.struct((-F.round("prob", 12)).alias("p"), "steps", "path")
    best = links.select(
        *by, F.col("parent").alias("src"), F.col("child").alias("dst"), F.col("step").alias("prob"), F.lit(1).alias("steps"),
        F.array("parent", "child").alias("path"), F.lit(True).alias("fresh"),
    )
    while True:
        ahead = links.withColumnRenamed("parent", "dst")
        longer = best.filter("fresh").join(ahead, [*by, "dst"]).filter("src <> child").select(
            *by, "src", F.col("child").alias("dst"), (F.col("prob") * F.col("step")).alias("prob"),
            (F.col("steps") + 1).alias("steps"), F.concat("path", F.array("child")).alias("path"), F.lit(True).alias("fresh"),
        )
        both = best.withColumn("fresh", F.lit(False)).unionByName(longer)
        found = both.groupBy(*key).agg(F.min_by(F.struct("prob", "steps", "path", "fresh"), F.struct(rank, "fresh")).alias("b"))
        best = materialise(found.select(*key, "b.*"), "paths")
        if best.filter("fresh").isEmpty():
            return best.drop("fresh")
