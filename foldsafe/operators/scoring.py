"""Model as a table: export, re-score, parity.

A fitted tree ensemble is exported as a flat node table
(tree_id, node_id, feature, threshold | left categories, left, right, value)
plus per-tree weights.  Re-scoring walks every (row, tree) pair down the
trees with one broadcast hash join per depth level: the node table's size
is bounded by trees x 2^(depth+1) and is checked before it is broadcast;
the rows are never shuffled until the final per-row sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_NODE_LIMIT = 2_000_000
EXPRESSION_NODE_LIMIT = 20_000


def export_tree_table(spark: SparkSession, model, path: str) -> DataFrame:
    """Save the model with Spark's own writer and read its node Parquet."""
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(path.rstrip("/") + "/data")
    flat = nodes.select(
        F.col("treeID").cast("int").alias("tree_id"),
        F.col("nodeData.id").cast("int").alias("node_id"),
        F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.leftChild").cast("int").alias("left"),
        F.col("nodeData.rightChild").cast("int").alias("right"),
        F.col("nodeData.split.featureIndex").cast("int").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("split_values"),
        F.col("nodeData.split.numCategories").cast("int").alias("num_categories"))
    # an ensemble carries its weights; a single tree has none
    weights = list(model.treeWeights) if hasattr(model, "trees") else [1.0]
    w = spark.createDataFrame(list(enumerate(map(float, weights))), "tree_id int, weight double")
    return flat.join(w, "tree_id")


def _go_left(x, thr, cats, ncat, comparator):
    cont = (x <= thr) if comparator == "le" else (x.cast("float") < thr.cast("float"))
    return F.when(ncat > 0, F.array_contains(cats, x)).otherwise(cont)


def tree_expression(nodes_rows: list, features: str, max_depth: int, comparator: str = "le"):
    """A small model compiled to one column expression: every tree's node
    arrays become literals and ``aggregate`` walks max_depth steps per tree.
    Rows are scored where they are: no explode, no join, no shuffle."""
    trees: dict[int, list] = {}
    for r in nodes_rows:
        trees.setdefault(r["tree_id"], []).append(r)
    total = None
    for t in sorted(trees):
        rows = sorted(trees[t], key=lambda r: r["node_id"])
        assert [r["node_id"] for r in rows] == list(range(len(rows))), "node ids must be dense"
        feat = F.array(*[F.lit(int(r["feature"] if r["feature"] is not None else -1)) for r in rows])
        left = F.array(*[F.lit(int(r["left"])) for r in rows])
        right = F.array(*[F.lit(int(r["right"])) for r in rows])
        thr = F.array(*[F.lit(float(r["split_values"][0]) if r["split_values"] else 0.0) for r in rows])
        ncat = F.array(*[F.lit(int(r["num_categories"] or -1)) for r in rows])
        cats = F.array(*[F.array(*[F.lit(float(v)) for v in (r["split_values"] or [])]).cast("array<double>") for r in rows])
        val = F.array(*[F.lit(float(r["value"])) for r in rows])
        weight = float(rows[0]["weight"])

        def step(n, _):
            i = n + 1
            x = F.try_element_at(F.col(features), F.element_at(feat, i) + 1)
            gl = _go_left(x, F.element_at(thr, i), F.element_at(cats, i), F.element_at(ncat, i), comparator)
            return F.when(F.element_at(left, i) < 0, n).when(gl, F.element_at(left, i)).otherwise(F.element_at(right, i))
        leaf = F.aggregate(F.sequence(F.lit(1), F.lit(max_depth)), F.lit(0), step)
        term = F.element_at(val, leaf + 1) * F.lit(weight)
        total = term if total is None else total + term
    return total


def score_tree_table(df: DataFrame, nodes: DataFrame, features: str, id_col: str, max_depth: int,
                     out: str = "pred", comparator: str = "le") -> DataFrame:
    """Σ_t weight_t · leaf_t(x).  ``comparator`` 'le' is Spark's (go left
    when x <= threshold); 'lt_f32' is the strict float32 comparison of the
    exported browser scorer.  A model of at most EXPRESSION_NODE_LIMIT nodes
    is compiled to a per-row expression (no shuffle); a larger one is walked
    with one broadcast join per depth level."""
    n_nodes = nodes.count()
    if n_nodes <= EXPRESSION_NODE_LIMIT:
        rows = nodes.select("tree_id", "node_id", "feature", "split_values", "num_categories", "left", "right",
                            "value", "weight").collect()                      # bounded by the check above
        return df.select(id_col, tree_expression(rows, features, max_depth, comparator).alias(out))
    nd = nodes.select("tree_id", "node_id", "feature", "split_values", "num_categories", "left", "right")
    nd = F.broadcast(nd) if n_nodes <= BROADCAST_NODE_LIMIT else nd
    trees = [r[0] for r in nodes.select("tree_id").distinct().collect()]          # bounded by the model
    state = df.select(id_col, features).distinct().withColumn("tree_id", F.explode(F.array(*[F.lit(t) for t in sorted(trees)])))
    state = state.withColumn("node_id", F.lit(0))
    for _ in range(max_depth):
        j = state.join(nd, ["tree_id", "node_id"], "left")
        x = F.try_element_at(F.col(features), F.col("feature") + 1)
        thr = F.try_element_at(F.col("split_values"), F.lit(1))
        if comparator == "le":
            cont_left = x <= thr
        else:
            cont_left = x.cast("float") < thr.cast("float")
        cat_left = F.array_contains(F.col("split_values"), x)
        go_left = F.when(F.col("num_categories") > 0, cat_left).otherwise(cont_left)
        nxt = F.when(F.col("left") < 0, F.col("node_id")).when(go_left, F.col("left")).otherwise(F.col("right"))
        state = j.select(id_col, features, "tree_id", F.coalesce(nxt, F.col("node_id")).alias("node_id"))
    leaves = nodes.select("tree_id", "node_id", "value", "weight")
    leaves = F.broadcast(leaves) if n_nodes <= BROADCAST_NODE_LIMIT else leaves
    s = state.join(leaves, ["tree_id", "node_id"])
    scored = s.groupBy(F.col(id_col).alias("__id"), F.col(features).alias("__x")).agg(F.sum(F.col("value") * F.col("weight")).alias(out))
    # rows that repeat an id, or a whole row, are each scored
    return (df.select(id_col, features).join(scored, F.col(id_col).eqNullSafe(F.col("__id")) & F.col(features).eqNullSafe(F.col("__x")))
            .select(id_col, out))


def size_budget(nodes: DataFrame, budget_kb: float, bytes_per_node: int = 28) -> DataFrame:
    """E27 re-aimed: fixed-width bytes per node (feature int32, threshold
    float64, children 2 x int32, leaf float64), cumulated over trees in id
    order, against a KB budget: how many trees fit."""
    from pyspark.sql import Window
    per = nodes.groupBy("tree_id").agg(F.count(F.lit(1)).alias("nodes"))
    per = per.withColumn("bytes", F.col("nodes") * bytes_per_node)
    w = Window.orderBy("tree_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)   # one row per tree
    per = per.withColumn("cum_kb", F.sum("bytes").over(w) / 1024.0)
    return per.withColumn("within_budget", (F.col("cum_kb") <= F.lit(budget_kb)).cast("int"))
