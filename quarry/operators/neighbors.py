"""Distance-based operators without all-pairs work.

* distances to a bounded set of target rows (what ``dist(x)[ind, ind]``
  inspects);
* exact one-feature k-nearest-neighbour classification: in sorted order the
  k nearest training values of a point lie within k positions on either
  side of its insertion point, found with the distributed row index;
* single-linkage clusters cut at height h = connected components of the
  h-neighbourhood graph, whose edges come from an exact bucketed radius
  join; components by large-star / small-star contraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.relational import with_row_index
from quarry.session import cut_lineage


def distances_to_targets(df: DataFrame, id_col: str, vec: str, targets: Sequence) -> DataFrame:
    """Euclidean distance of every row to each target row.  The target rows
    (a short list by construction) enter as a one-row scalar array and are
    exploded per row: work = rows x |targets|."""
    tv = df.where(F.col(id_col).isin(list(targets))).agg(
        F.array_sort(F.collect_list(F.struct(F.col(id_col).alias("target"), F.col(vec).alias("tv")))).alias("t")).scalar()
    r = df.select(id_col, vec, F.explode(tv).alias("_t"))
    d = F.sqrt(F.aggregate(F.zip_with(F.col(vec), F.col("_t.tv"), lambda a, b: (a.cast("double") - b.cast("double")) ** 2),
                           F.lit(0.0), lambda acc, x: acc + x))
    return r.select(F.col("_t.target").alias("target"), id_col, d.alias("dist"))


def knn_1d(train: DataFrame, test: DataFrame, id_col: str, x: str, label: str, k_max: int) -> DataFrame:
    """For each test row, its ``k_max`` nearest training rows on feature
    ``x`` with neighbour rank 1..k_max and label.  Exact; work
    O((n + m) log + m k).

    Ties: smaller distance, then smaller value, then the row nearer to the
    insertion point in (value, id) order -- larger id below the test value,
    smaller id at or above it -- so the chosen rows are always a contiguous
    run of at most k positions on each side."""
    tr = train.select(F.col(id_col).alias("uid"), F.col(x).alias("ux"), F.col(label).alias("tr_label"), F.lit(1).alias("kind"))
    te = test.select(F.col(id_col).alias("uid"), F.col(x).alias("ux"), F.lit(None).cast(tr.schema["tr_label"].dataType)
                     .alias("tr_label"), F.lit(0).alias("kind"))
    # one index over the union, ordered by value with test rows before training
    # rows of equal value: the running count of training rows is a training
    # row's own position and, for a test row, its insertion point
    ix = with_row_index(tr.unionByName(te), ["ux", "kind", "uid"], "_u", prefix_counts={"n_train": F.col("kind") == 1})
    tr_ix = ix.where(F.col("kind") == 1).select(F.col("n_train").alias("tr_pos"), F.col("uid").alias("tr_id"),
                                                F.col("ux").alias("tr_x"), "tr_label")
    ins = ix.where(F.col("kind") == 0).select(F.col("uid").alias("te_id"), F.col("ux").alias("te_x"),
                                              F.col("n_train").alias("before"))
    cand = ins.withColumn("tr_pos", F.explode(F.sequence(F.greatest(F.col("before") - k_max + 1, F.lit(1)),
                                                          F.col("before") + k_max)))
    j = cand.join(tr_ix, "tr_pos").withColumn("dist", F.abs(F.col("tr_x") - F.col("te_x")))
    near = F.when(F.col("tr_x") < F.col("te_x"), -F.col("tr_id")).otherwise(F.col("tr_id"))
    w = Window.partitionBy("te_id").orderBy("dist", "tr_x", near)
    return j.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k_max) \
        .select("te_id", "te_x", "nn_rank", "tr_id", "tr_label", "dist")


def knn_scan(neighbours: DataFrame, truth: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Majority vote of the first k neighbours for every k (ties go to the
    nearest neighbour's label); accuracy and F1 of class 1 per k."""
    w = Window.partitionBy("te_id").orderBy("nn_rank").rowsBetween(Window.unboundedPreceding, 0)
    c = neighbours.withColumn("ones", F.sum("tr_label").over(w)) \
        .withColumn("first", F.first("tr_label").over(Window.partitionBy("te_id").orderBy("nn_rank")))
    c = c.where(F.col("nn_rank").isin(list(ks))).withColumn(
        "pred", F.when(2 * F.col("ones") > F.col("nn_rank"), 1).when(2 * F.col("ones") < F.col("nn_rank"), 0)
        .otherwise(F.col("first")))
    j = c.join(truth, "te_id")
    tp = F.count_if((F.col("pred") == 1) & (F.col("y") == 1))
    fp = F.count_if((F.col("pred") == 1) & (F.col("y") == 0))
    fn = F.count_if((F.col("pred") == 0) & (F.col("y") == 1))
    return j.groupBy(F.col("nn_rank").alias("k")).agg(
        F.avg((F.col("pred") == F.col("y")).cast("double")).alias("accuracy"), (2 * tp / (2 * tp + fp + fn)).alias("f1"))


def _large_star(e: DataFrame) -> DataFrame:
    """Every node u links each larger neighbour to min(N(u) + u)."""
    d = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    m = d.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return d.where(F.col("b") > F.col("a")).join(m, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """Every node u links itself and its smaller neighbours to their minimum."""
    d = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).where(F.col("b") < F.col("a"))
    m = d.groupBy("a").agg(F.min("b").alias("m"))
    out = d.join(m, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .unionByName(m.select("a", F.col("m").alias("b")))
    return out


def _canon(e: DataFrame) -> DataFrame:
    return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame, vertices: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """Connected components by alternating large-star / small-star
    contraction (each pair of rounds checkpointed) until the edge set stops
    changing; O(log^2 n) rounds instead of one per unit of graph diameter.
    Returns v, component (smallest vertex id of the component)."""
    e = cut_lineage(_canon(edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))))
    for _ in range(max_rounds):
        nxt = cut_lineage(_canon(_small_star(_canon(_large_star(e)))))
        same = nxt.exceptAll(e).unionByName(e.exceptAll(nxt)).limit(1).count() == 0
        e = nxt
        if same:
            comp = e.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("component"))
            return vertices.select("v").join(comp, "v", "left") \
                .select("v", F.least(F.coalesce("component", F.col("v")), F.col("v")).alias("component"))
    raise RuntimeError("connected components did not converge")
