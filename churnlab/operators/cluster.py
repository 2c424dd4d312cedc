"""Customer segmentation (K1-K8).

Fitting uses Spark ML ``KMeans`` on an assembled vector column; the
assignment step for given centres, the profiles and the cluster names are
plain DataFrame expressions.  Centres are folded into rows of a bounded
number of centres each and attached to every data row block by block, so
assignment is a map-side projection: no shuffle, no per-row Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.columns import full
from churnlab.operators.profile import attach_scalars
from churnlab.session import materialize

# centres attached to a data row at a time
CENTRE_BLOCK = 1024


def as_vector(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Assemble feature columns into an ML vector (JVM-side)."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def fit_kmeans(vectors: DataFrame, k: int, seed: int = S.SEED, features: str = "features", max_iter: int = 20):
    """K3 fit.  The data are repartitioned by key upstream so a fixed seed
    gives a reproducible model."""
    from pyspark.ml.clustering import KMeans
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster", maxIter=max_iter).fit(vectors)


def elbow(vectors: DataFrame, ks: Sequence[int], seed: int = S.SEED, features: str = "features",
          silhouette: bool = True) -> DataFrame:
    """K1 + K2: inertia (training cost) and, optionally, silhouette per k.
    One distributed fit per k over the cached vectors; one row per k."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    ev = ClusteringEvaluator(featuresCol=features, predictionCol="cluster")
    rows = []
    for k in ks:
        m = fit_kmeans(vectors, k, seed, features)
        sil = float(ev.evaluate(m.transform(vectors))) if silhouette else None
        rows.append((int(k), float(m.summary.trainingCost), sil))
    return vectors.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def centre_blocks(centres: DataFrame, id_col: str, vec_col: str, size: int = CENTRE_BLOCK) -> list[DataFrame]:
    """A centre table (id, array<double>) as one-row tables that hold about
    ``size`` centres each (cut by a hash of the id)."""
    rows = materialize(centres.select(F.col(id_col).alias("cid"), F.col(vec_col).cast("array<double>").alias("cv")),
                       "centres")
    n = max(1, -(-rows.count() // size))
    fold = F.sort_array(F.collect_list(F.struct("cid", "cv"))).alias("_centres")
    return [rows.where(F.pmod(F.xxhash64("cid"), F.lit(n)) == i).agg(fold) for i in range(n)]


def sq_distance(x: Column, c: Column) -> Column:
    """Squared Euclidean distance of two equal-length arrays, summed left to right."""
    return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v)


def nearest_center(df: DataFrame, vec_col: str, centres: DataFrame, id_col: str = "cid",
                   centre_vec: str = "cv", decimals: int = 9, cluster_col: str = "cluster") -> DataFrame:
    """K4: id of the nearest centre (squared Euclidean, rounded to
    ``decimals`` before the tie-break; lowest id wins a tie) and its distance.
    Any number of centres: rows are held against one block after another and
    keep the best so far."""
    blocks = centre_blocks(centres, id_col, centre_vec)
    x = F.col(vec_col).cast("array<double>")
    out, best = df, None
    for block in blocks:
        near = F.array_min(F.transform(F.col("_centres"), lambda c: F.struct(
            F.round(sq_distance(x, c["cv"]), decimals).alias("d"), c["cid"].alias("cid"))))
        best = near if best is None else F.least(F.col("_best"), near)
        out = attach_scalars(out, block).withColumn("_best", best).drop("_centres")
    return out.select(*df.columns, F.col("_best.cid").alias(cluster_col), F.col("_best.d").alias("distance"))


def cluster_profile(df: DataFrame, cluster_col: str, features: Sequence[str]) -> DataFrame:
    """K5: size and mean of every feature per cluster (long form: cluster,
    feature, n, mean).  One unpivot + one partial aggregation."""
    long = df.select(F.col(cluster_col).alias("cluster"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in features])))
    return long.groupBy("cluster", "feature").agg(F.count(F.lit(1)).alias("n"), full(F.avg("x")).alias("mean"))


def array_profile(df: DataFrame, cluster_col: str, vec_col: str, prefix: str = "dim_") -> DataFrame:
    """K5 for an array column: mean of every position per cluster."""
    long = df.select(F.col(cluster_col).alias("cluster"), F.posexplode(F.col(vec_col).cast("array<double>")))
    return long.groupBy("cluster", "pos").agg(F.count(F.lit(1)).alias("n"), full(F.avg("col")).alias("mean")).select(
        "cluster", F.format_string(prefix + "%02d", F.col("pos")).alias("feature"), "n", "mean")


def cluster_target_rate(df: DataFrame, cluster_col: str, label_col: str) -> DataFrame:
    """K6: rows and positive rate (%) per cluster, with the overall rate."""
    g = df.groupBy(F.col(cluster_col).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label_col).cast("long")).alias("_pos"))
    every = Window.partitionBy()  # over the cluster table (k rows)
    overall = F.sum("_pos").over(every) / F.sum("n").over(every)
    return g.select("cluster", "n", full(F.col("_pos") / F.col("n") * 100.0).alias("churn_rate"),
                    full(overall * 100.0).alias("overall_rate"))


def name_clusters(df: DataFrame, cluster_col: str, features: Sequence[str], top: int = S.TOP_K_SHORT) -> DataFrame:
    """K7: the ``top`` features whose cluster mean deviates most from the
    global mean, in units of the global (population) std."""
    long = df.select(F.col(cluster_col).alias("cluster"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in features])))
    # one pass over the data: per (cluster, feature) count, mean and squared
    # deviations; the global mean and population std are combined from that
    # small table (pooled-variance formula, numerically stable)
    per = long.where(F.col("x").isNotNull()).groupBy("cluster", "feature").agg(
        F.count("x").alias("_n"), F.avg("x").alias("_cm"), (F.var_pop("x") * F.count("x")).alias("_m2"))
    by_f = Window.partitionBy("feature")  # clusters of one feature
    gm = F.sum(F.col("_n") * F.col("_cm")).over(by_f) / F.sum("_n").over(by_f)
    per = per.select("*", gm.alias("_gm"))
    m2 = F.sum(F.col("_m2") + F.col("_n") * (F.col("_cm") - F.col("_gm")) * (F.col("_cm") - F.col("_gm"))).over(by_f)
    gs = F.sqrt(m2 / F.sum("_n").over(by_f))
    z = per.select("cluster", "feature",
                   F.try_divide(F.col("_cm") - F.col("_gm"), F.when(gs > 0, gs)).alias("_z"))
    w = Window.partitionBy("cluster").orderBy(F.abs(F.col("_z")).desc_nulls_last(), "feature")  # features per cluster
    ranked = z.select("*", F.row_number().over(w).alias("rank")).where(F.col("rank") <= top)
    return ranked.select("cluster", "rank", "feature", full("_z").alias("z"),
                         F.when(F.col("_z") > 0, "high").when(F.col("_z") < 0, "low").otherwise("average")
                         .alias("direction"))


def attach_cluster(df: DataFrame, assignments: DataFrame, key: str, cluster_col: str = "cluster") -> DataFrame:
    """K8: add the cluster as a feature by a keyed left join (never by position)."""
    return df.join(assignments.select(key, cluster_col), on=key, how="left")
