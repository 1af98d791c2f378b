"""Feature transforms, linear algebra and clustering over the embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import GaussianMixtureModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from statweave.functions.arrays import append_bias, elementwise_product, with_vector
from statweave.operators import clustering, features
from statweave.queries.registry import query, rounded, scratch
from statweave.sources.models import centers_table, load_model, save_model
from statweave.sources.tables import table

WIDTH = 64
LONG_SQL = "(SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, (generate_subscripts(embedding, 1) - 1)::INTEGER AS i FROM embeddings)"


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"), F.col("embedding").cast("array<double>").alias("features")
    )


@query("elementwise", f"SELECT vec_id, i AS feature, round(v * (i % 3), 6) + 0.0 AS value FROM {LONG_SQL}")
def elementwise(spark, sf):
    scaled = vectors(spark, sf).select("vec_id", elementwise_product(F.col("features"), [i % 3 for i in range(WIDTH)]).alias("s"))
    return rounded(scaled.select("vec_id", F.posexplode("s").alias("feature", "value")))


@query("elementwise_vector", f"SELECT vec_id, round(sum(v * (i % 3)), 6) + 0.0 AS total FROM {LONG_SQL} GROUP BY vec_id")
def elementwise_vector(spark, sf):
    scaled = features.scale_vectors(with_vector(vectors(spark, sf), "features"), [i % 3 for i in range(WIDTH)])
    total = F.aggregate(vector_to_array("scaled"), F.lit(0.0), lambda s, v: s + v)
    return rounded(scaled.select("vec_id", total.alias("total")))


@query(
    "append_bias",
    "SELECT vec_id, (len(embedding) + 1)::INTEGER AS width, round(list_sum(embedding::DOUBLE[]) + 1, 5) AS total FROM embeddings",
)
def bias_appended(spark, sf):
    longer = vectors(spark, sf).select("vec_id", append_bias(F.col("features")).alias("f"))
    total = F.aggregate("f", F.lit(0.0), lambda s, v: s + v)
    return rounded(longer.select("vec_id", F.size("f").alias("width"), total.alias("total")), 5)


DIGIT_SQL = f"SELECT i AS feature, floor(v * 100 / 16) AS a, label AS b FROM {LONG_SQL}"


def binned_vectors(spark, sf):
    values = F.transform("features", lambda v: F.floor(v * 100 / 16).cast("double"))
    return vectors(spark, sf).withColumn("features", values)


RANK_SQL = f"""WITH raw AS ({DIGIT_SQL}), o AS (SELECT feature, a, b, count(*) AS o FROM raw GROUP BY ALL),
    r AS (SELECT feature, a, count(*) AS r FROM raw GROUP BY ALL), c AS (SELECT feature, b, count(*) AS c FROM raw GROUP BY ALL),
    n AS (SELECT feature, count(*)::DOUBLE AS n FROM raw GROUP BY ALL),
    t AS (SELECT r.feature, coalesce(o.o, 0) AS o, r.r * c.c / n.n AS e FROM n JOIN r USING (feature) JOIN c USING (feature)
          LEFT JOIN o ON o.feature = r.feature AND o.a = r.a AND o.b = c.b),
    x AS (SELECT feature, sum((o - e) * (o - e) / e) AS statistic FROM t GROUP BY feature)"""


@query("chi2_ranking", f"{RANK_SQL} SELECT feature, round(statistic, 6) AS statistic FROM x")
def chi2_ranking(spark, sf):
    return rounded(features.chi2_ranking(binned_vectors(spark, sf)))


@query(
    "chi2_select",
    f"""{RANK_SQL}, s AS (SELECT feature FROM x ORDER BY statistic DESC, feature LIMIT 50), k AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS position FROM s)
    SELECT vec_id, position::INTEGER AS position, floor(v * 100 / 16) + 0.0 AS value FROM {LONG_SQL} JOIN k ON i = feature""",
)
def chi2_select(spark, sf):
    rows = binned_vectors(spark, sf)
    kept = features.keep_features(rows, features.chi2_top_features(rows, 50))
    return rounded(kept.select("vec_id", F.posexplode("selected").alias("position", "value")))


@query("gramian", f"SELECT a.i, b.i AS j, round(sum(a.v * b.v), 5) + 0.0 AS value FROM {LONG_SQL} a JOIN {LONG_SQL} b USING (vec_id) GROUP BY a.i, b.i")
def gramian(spark, sf):
    return rounded(features.gramian(vectors(spark, sf)), 5)


# a fixed 64×3 matrix given by a rule
LOCAL = np.array([[((i * 7 + k * 3) % 11 - 5) / 5 for k in range(3)] for i in range(WIDTH)])
PRODUCT_SQL = f"""SELECT vec_id, k::INTEGER AS k, round(sum(v * ((i * 7 + k * 3) % 11 - 5) / 5.0), 6) + 0.0 AS value
    FROM {LONG_SQL}, (SELECT unnest([0, 1, 2]) AS k) GROUP BY vec_id, k"""


@query("matrix_product", PRODUCT_SQL)
def matrix_product(spark, sf):
    product = features.matrix_product(vectors(spark, sf), LOCAL)
    return rounded(product.select("vec_id", F.posexplode("product").alias("k", "value")))


@query("matrix_product_long", PRODUCT_SQL)
def matrix_product_long(spark, sf):
    cells = vectors(spark, sf).select(F.col("vec_id").alias("row"), F.posexplode("features").alias("j", "value"))
    entries = [(j, k, float(LOCAL[j, k])) for j in range(WIDTH) for k in range(3)]
    product = features.matrix_product_long(cells, spark.createDataFrame(entries, "j int, k int, weight double"))
    return rounded(product.select(F.col("row").alias("vec_id"), "k", "value"))


def _norm(name: str):
    return F.aggregate(name, F.lit(0.0), lambda s, v: s + v * v)


@query("pca")
def pca(spark, sf):
    model = features.principal_components(vectors(spark, sf), 3)
    return features.project_components(model, vectors(spark, sf)).select("vec_id", F.posexplode(vector_to_array("pca")).alias("component", "value"))


@query("pca_norms", f"SELECT vec_id, round(sum(v * v), 6) AS norm FROM {LONG_SQL} GROUP BY vec_id")
def pca_norms(spark, sf):
    """With every component kept the projection is a rotation, so row norms do not change."""
    model = features.principal_components(vectors(spark, sf), WIDTH)
    projected = features.project_components(model, vectors(spark, sf)).withColumn("p", vector_to_array("pca"))
    return rounded(projected.select("vec_id", _norm("p").alias("norm")))


@query("svd")
def svd(spark, sf):
    u, s, _ = features.truncated_svd(vectors(spark, sf), 3)
    return u.select("vec_id", F.posexplode("u").alias("component", "value")).withColumn(
        "singular_value", F.element_at(F.array(*[F.lit(float(x)) for x in s]), F.col("component") + 1)
    )


@query("svd_reconstruct", f"SELECT vec_id, i AS feature, round(v, 5) + 0.0 AS value FROM {LONG_SQL}")
def svd_reconstruct(spark, sf):
    """U·s·Vᵀ of the full decomposition gives the rows back."""
    u, s, v = features.truncated_svd(vectors(spark, sf), WIDTH)
    back = features.matrix_product(u, (v * s).T, "u", "back")
    return rounded(back.select("vec_id", F.posexplode("back").alias("feature", "value")), 5)


def label_centers(spark, sf) -> list[list[float]]:
    """Mean vector of each of the labels: one row per label and position."""
    long = vectors(spark, sf).select("label", F.posexplode("features").alias("i", "v"))
    means = long.groupBy("label", "i").agg(F.round(F.avg("v"), 9).alias("m"))
    rows = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("c"))
    return [r.c for r in rows.orderBy("label").collect()]


CENTER_SQL = f"""WITH c AS (SELECT label AS cluster, i, round(avg(v), 9) AS m FROM {LONG_SQL} GROUP BY label, i),
    d AS (SELECT vec_id, cluster, sum((v - m) * (v - m)) AS distance FROM {LONG_SQL} e JOIN c USING (i) GROUP BY vec_id, cluster),
    b AS (SELECT vec_id, min(distance) AS distance, arg_min(cluster, distance) AS cluster FROM d GROUP BY vec_id)"""


@query("kmeans_assign", f"{CENTER_SQL} SELECT vec_id, cluster::INTEGER AS cluster, round(distance, 6) AS distance FROM b")
def kmeans_assign(spark, sf):
    found = clustering.assign_clusters(vectors(spark, sf), label_centers(spark, sf))
    return rounded(found.select("vec_id", "cluster", "distance"))


@query("kmeans_cost", f"{CENTER_SQL} SELECT round(sum(distance), 5) AS cost FROM b")
def kmeans_cost(spark, sf):
    return rounded(clustering.clustering_cost(vectors(spark, sf), label_centers(spark, sf)), 5)


@query("kmeans")
def kmeans(spark, sf):
    model = clustering.fit_kmeans(vectors(spark, sf), 2, 20)
    cost = float(model.summary.trainingCost)
    return centers_table(spark, model.clusterCenters()).withColumn("cost", F.lit(cost))


@query("kmeans_agreement", "SELECT count(*) AS n, 0::BIGINT AS different FROM embeddings")
def kmeans_agreement(spark, sf):
    """Clusters of a fitted model beside the nearest of its centres, row by row."""
    rows = vectors(spark, sf)
    model = clustering.fit_kmeans(rows, 10, 20)
    mine = clustering.assign_clusters(rows, [list(map(float, c)) for c in model.clusterCenters()])
    both = model.transform(with_vector(mine, "features"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cluster") != F.col("prediction")).alias("different"))


@query("bisecting_kmeans")
def bisecting_kmeans(spark, sf):
    model = clustering.fit_bisecting_kmeans(vectors(spark, sf), 4)
    centers = [list(map(float, c)) for c in model.clusterCenters()]
    return clustering.clustering_cost(vectors(spark, sf), centers).withColumn("clusters", F.lit(len(centers)))


@query("gaussian_mixture")
def gaussian_mixture(spark, sf):
    """Two components over all columns, saved, loaded and listed."""
    rows = vectors(spark, sf)
    model = clustering.fit_gaussian_mixture(rows, 2)
    loaded = load_model(GaussianMixtureModel, save_model(model, scratch(spark, "mixture")))
    return clustering.mixture_table(loaded, rows)
