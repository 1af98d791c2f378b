"""Power iteration on the row-normalised similarity matrix, as joins over edges written once.

Edges are written once, both directions, divided by the degree of their row. A step joins them with the
current vector on the column and sums per row (combined before the shuffle), then scales the
vector to a sum of 1. A node with more than ``SPLIT`` edges is dealt over several salts and its
entry of the vector is repeated for each, so no task holds all edges of a hot node. Vectors
are tables; the driver learns two numbers a step. The start is each node's share of all degrees.

Null weights and ids, loops and weights of 0 or less are left out; edges given twice add up. No edges
give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statweave.plans.staging import stage_table

SPLIT = 100_000


def _normalised(edges: DataFrame, split: int) -> tuple[DataFrame, DataFrame]:
    """(edges ``i, j, salt, a`` with a = weight / degree of i, nodes ``id, degree, salts``), staged."""
    usable = edges.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst AND weight > 0")
    forth = usable.select(F.col("src").alias("i"), F.col("dst").alias("j"), F.col("weight").cast("double").alias("w"))
    both = forth.unionByName(forth.select(F.col("j").alias("i"), F.col("i").alias("j"), "w")).groupBy("i", "j").agg(F.sum("w").alias("w"))
    both = stage_table(both)
    nodes = both.groupBy(F.col("i").alias("id")).agg(F.sum("w").alias("degree"), F.ceil(F.count("*") / split).cast("int").alias("salts"))
    nodes = stage_table(nodes)
    with_degree = both.join(nodes.select(F.col("id").alias("i"), "degree"), "i")
    salted = with_degree.join(nodes.select(F.col("id").alias("j"), "salts"), "j")
    ready = salted.select("i", "j", F.pmod(F.xxhash64("i"), F.col("salts")).cast("int").alias("salt"), (F.col("w") / F.col("degree")).alias("a"))
    slots = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage_table(ready.repartition(slots, "j", "salt")), nodes


def power_iteration_steps(edges: DataFrame, iterations: int = 10, tolerance: float = 0.0, split: int = SPLIT) -> DataFrame:
    """``iteration, id, value, change``: the vector after each step and how much it moved (sum of absolute differences).

    Stops early when a step moves the vector by less than ``tolerance``. Iteration 0 is the start.
    """
    matrix, nodes = _normalised(edges, split)
    total = nodes.agg(F.sum("degree")).first()[0] or 1.0
    vector = stage_table(nodes.select("id", (F.col("degree") / total).alias("value")))
    result = vector.select(F.lit(0).alias("iteration"), "id", "value", F.lit(None).cast("double").alias("change"))
    repeats = nodes.select("id", "salts")
    for step in range(1, iterations + 1):
        entries = vector.join(repeats, "id").select(
            F.col("id").alias("j"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "value"
        )
        product = stage_table(
            matrix.join(entries, ["j", "salt"]).groupBy(F.col("i").alias("id")).agg(F.sum(F.col("a") * F.col("value")).alias("value"))
        )
        scale = product.agg(F.sum("value")).first()[0]
        if not scale:
            break
        after = stage_table(product.select("id", (F.col("value") / scale).alias("value")))
        moved = after.join(vector.select("id", F.col("value").alias("_old")), "id").agg(F.sum(F.abs(F.col("value") - F.col("_old")))).first()[0]
        vector = after
        result = result.unionByName(vector.select(F.lit(step).alias("iteration"), "id", "value", F.lit(moved).cast("double").alias("change")))
        if moved < tolerance:
            break
    return result
