"""Registry entries for segmentation (K1-K8).

K4-K8 assign rows to GIVEN centres (the deterministic seeded start of
k-means: the first k rows in md5('42|key') order, or the first vec_ids), so
they have exact SQL twins; K1-K3 fit Spark ML KMeans and are rows-only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlab import spec as S
from churnlab.functions.columns import r6
from churnlab.operators import cluster as K
from churnlab.operators import lloyd as L
from churnlab.operators.model import fit_order
from churnlab.plans.q_prepare import FEATURES, fitted
from churnlab.plans.registry import W, query
from churnlab.plans.sql import SPLIT_CTE
from churnlab.session import materialize
from churnlab.sources import tables as T

N_CENTRES = 4
N_EMB_CENTRES = 10


# ------------------------------------------------------------- embeddings
def _emb_centres(e: DataFrame) -> DataFrame:
    return e.orderBy("vec_id").limit(N_EMB_CENTRES).select(F.col("vec_id").alias("cid"),
                                                           F.col("embedding").alias("cv"))


def emb_assigned(spark: SparkSession, d: str) -> DataFrame:
    e = T.load(spark, d, "embeddings")
    return K.nearest_center(e, "embedding", _emb_centres(e))


_EMB_CTE = f"""
c AS (SELECT vec_id AS cid, CAST(embedding AS DOUBLE[]) AS cv FROM embeddings ORDER BY vec_id LIMIT {N_EMB_CENTRES}),
d AS (SELECT e.vec_id, e.embedding, c.cid,
             round(list_reduce(list_transform(range(1, len(c.cv) + 1),
                                              lambda i: (CAST(e.embedding AS DOUBLE[])[i] - c.cv[i])
                                                        * (CAST(e.embedding AS DOUBLE[])[i] - c.cv[i])),
                               lambda a, b: a + b), 9) AS dist
      FROM embeddings e, c),
a AS (SELECT vec_id, embedding, cid AS cluster, dist AS distance FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cid) AS rn FROM d) WHERE rn = 1)"""


@query("k4_nearest", W(_EMB_CTE, "SELECT vec_id, cluster, distance FROM a"))
def k4_nearest(spark, d):
    return emb_assigned(spark, d).select("vec_id", "cluster", "distance")


@query("k5_profile_embeddings", W(_EMB_CTE, """
SELECT cluster, printf('dim_%02d', pos - 1) AS feature, count(*) AS n, round(CAST(avg(x) AS DOUBLE), 6) + 0.0 AS mean
FROM (SELECT cluster, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(1, len(embedding) + 1)) AS pos FROM a)
GROUP BY cluster, pos"""))
def k5_profile_embeddings(spark, d):
    return K.array_profile(emb_assigned(spark, d), "cluster", "embedding")


# ------------------------------------------------------------- subscribers
def subs_scaled(spark: SparkSession, d: str) -> DataFrame:
    """D13 output: every feature standardised with train statistics.  The
    split and the fit are made once and shared by all that reads this."""
    sp, model = fitted(spark, d, scale_all=True)
    return model.transform(sp, keep=["split"])


def subs_centres(scaled: DataFrame, k: int = N_CENTRES) -> DataFrame:
    """Seeded start: the first k train rows in md5('42|key') order."""
    h = F.md5(F.concat(F.lit(f"{S.SEED}|"), F.col("c_custkey").cast("string")))
    first = (scaled.where(F.col("split") == "train").select("c_custkey", h.alias("_h"), *FEATURES)
             .orderBy("_h", "c_custkey").limit(k))
    w = Window.orderBy("_h", "c_custkey")  # k rows
    return first.select((F.row_number().over(w) - 1).alias("cid"), F.array(*FEATURES).alias("cv"))


def subs_assigned(spark: SparkSession, d: str) -> DataFrame:
    scaled = subs_scaled(spark, d)
    vec = scaled.withColumn("_vec", F.array(*FEATURES))
    return K.nearest_center(vec, "_vec", subs_centres(scaled)).drop("_vec")


def _scaled_all_cte() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES)
    outs = ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END AS {c}"
                     for c in FEATURES)
    dist = " + ".join(f"(s.{c} - c.{c}) * (s.{c} - c.{c})" for c in FEATURES)
    return SPLIT_CTE + f""",
st AS (SELECT {stats} FROM split WHERE split = 'train'),
scaled AS (SELECT c_custkey, label, split, {outs} FROM split, st),
cen AS (SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY md5('42|' || CAST(c_custkey AS VARCHAR)), c_custkey) - 1
                              AS INTEGER) AS cid, * EXCLUDE (c_custkey, label, split)
                       FROM scaled WHERE split = 'train') WHERE cid < {N_CENTRES}),
dd AS (SELECT s.*, c.cid, round({dist}, 9) AS dist FROM scaled s, cen c),
assigned AS (SELECT * EXCLUDE (cid, dist, rn), cid AS cluster, dist AS distance FROM (
   SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY dist, cid) AS rn FROM dd) WHERE rn = 1)"""


_SUBS_K = _scaled_all_cte()


@query("k4_nearest_subs", W(_SUBS_K, "SELECT c_custkey, cluster, distance FROM assigned"))
def k4_nearest_subs(spark, d):
    return subs_assigned(spark, d).select("c_custkey", "cluster", "distance")


@query("k5_profile", W(_SUBS_K + ",\nlong AS (" + "\nUNION ALL\n".join(
    f"SELECT cluster, '{c}' AS feature, {c} AS x FROM assigned" for c in FEATURES) + ")", """
SELECT cluster, feature, count(*) AS n, round(CAST(avg(x) AS DOUBLE), 6) + 0.0 AS mean FROM long GROUP BY cluster, feature"""))
def k5_profile(spark, d):
    return K.cluster_profile(subs_assigned(spark, d), "cluster", FEATURES)


@query("k6_cluster_rate", W(_SUBS_K, """
SELECT cluster, count(*) AS n, round(CAST(avg(CAST(label AS DOUBLE)) * 100.0 AS DOUBLE), 6) + 0.0 AS churn_rate,
       round((SELECT avg(CAST(label AS DOUBLE)) FROM assigned) * 100.0, 6) + 0.0 AS overall_rate
FROM assigned GROUP BY cluster"""))
def k6_cluster_rate(spark, d):
    return K.cluster_target_rate(subs_assigned(spark, d), "cluster", "label")


@query("k7_cluster_names", W(_SUBS_K + ",\nlong AS (" + "\nUNION ALL\n".join(
    f"SELECT cluster, '{c}' AS feature, {c} AS x FROM assigned" for c in FEATURES) + """),
gstat AS (SELECT feature, avg(x) AS gm, stddev_pop(x) AS gs FROM long GROUP BY feature),
per AS (SELECT cluster, feature, avg(x) AS cm FROM long GROUP BY cluster, feature),
z AS (SELECT p.cluster, p.feature, (p.cm - g.gm) / nullif(g.gs, 0) AS z FROM per p JOIN gstat g ON p.feature = g.feature),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY cluster ORDER BY abs(z) DESC NULLS LAST, feature) AS INTEGER)
             AS rank FROM z)""",
    f"""
SELECT cluster, rank, feature, round(CAST(z AS DOUBLE), 6) + 0.0 AS z,
       CASE WHEN z > 0 THEN 'high' WHEN z < 0 THEN 'low' ELSE 'average' END AS direction
FROM r WHERE rank <= {S.TOP_K_SHORT}"""))
def k7_cluster_names(spark, d):
    return K.name_clusters(subs_assigned(spark, d), "cluster", FEATURES)


@query("k8_attach", W(_SUBS_K, """
SELECT s.c_custkey, s.split, s.label, a.cluster FROM split s LEFT JOIN assigned a ON s.c_custkey = a.c_custkey"""))
def k8_attach(spark, d):
    scaled = subs_scaled(spark, d)
    assignments = K.nearest_center(scaled.withColumn("_vec", F.array(*FEATURES)), "_vec", subs_centres(scaled))
    return K.attach_cluster(scaled, assignments, "c_custkey").select("c_custkey", "split", "label", "cluster")


# ------------------------------------------------------------- Spark ML KMeans (rows-only)
def train_vectors(scaled: DataFrame) -> DataFrame:
    """Train rows as vectors in a fixed partitioning and order, so a seed reproduces the fit."""
    train = fit_order(scaled.where(F.col("split") == "train"), "c_custkey")
    return K.as_vector(train, FEATURES).select("c_custkey", "label", "features")


@query("k1_elbow")
def k1_elbow(spark, d):
    v = train_vectors(subs_scaled(spark, d)).persist()
    try:
        return K.elbow(v, range(2, 7), silhouette=False).select("k", "inertia")
    finally:
        v.unpersist()


@query("k2_silhouette")
def k2_silhouette(spark, d):
    v = train_vectors(subs_scaled(spark, d)).persist()
    try:
        res = K.elbow(v, range(2, 7))
    finally:
        v.unpersist()
    best = res.agg(F.min_by("k", F.struct(-F.col("silhouette"), F.col("k"))).alias("_best"))
    return res.select("k", "silhouette", (F.col("k") == best.scalar()).alias("chosen"))


@query("k3_assign")
def k3_assign(spark, d):
    return _assigned(spark, d)[0].select("c_custkey", "split", "cluster")


def _assigned(spark, d):
    """All rows with the cluster of a KMeans fitted on the train rows, and the model."""
    scaled = subs_scaled(spark, d)
    v = train_vectors(scaled).persist()
    try:
        model = K.fit_kmeans(v, N_CENTRES)
    finally:
        v.unpersist()
    return model.transform(K.as_vector(scaled, FEATURES)), model


@query("k1_inertia_one", W(_SUBS_K, "SELECT count(*) AS n, round(CAST(" + " + ".join(
    f"var_pop({c}) * count(*)" for c in FEATURES) + " AS DOUBLE), 6) + 0.0 AS inertia FROM scaled WHERE split = 'train'"))
def k1_inertia_one(spark, d):
    """Inertia for one cluster, whose centre is the mean."""
    train = subs_scaled(spark, d).where(F.col("split") == "train")
    mean = train.agg(F.lit(0).alias("cid"), F.array(*[F.avg(c) for c in FEATURES]).alias("cv"))
    near = K.nearest_center(train.withColumn("_vec", F.array(*FEATURES)), "_vec", mean, decimals=12)
    return near.agg(F.count(F.lit(1)).alias("n"), F.sum("distance").alias("inertia"))


@query("k1_elbow_check", "SELECT 5 AS n_ks, 0 AS n_above_previous, 0 AS n_above_one_cluster")
def k1_elbow_check(spark, d):
    """More clusters never cost more (up to the fit's own tolerance), and less than one cluster."""
    v = train_vectors(subs_scaled(spark, d)).persist()
    try:
        res = K.elbow(v, range(2, 7), silhouette=False)
        n = v.count()
    finally:
        v.unpersist()
    steps = res.withColumn("before", F.lag("inertia").over(Window.orderBy("k")))  # one row per k
    return steps.agg(F.count(F.lit(1)).cast("int").alias("n_ks"),
                     F.count_if(F.col("inertia") > F.col("before") * 1.05).cast("int").alias("n_above_previous"),
                     F.count_if(F.col("inertia") > n * len(FEATURES)).cast("int").alias("n_above_one_cluster"))


@query("k3_assign_check", W(SPLIT_CTE, f"""
SELECT split, count(*) AS n, CAST({N_CENTRES} AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS n_not_nearest
FROM split GROUP BY split"""))
def k3_assign_check(spark, d):
    """Every row has one of the clusters, and it is the nearest of the model's centres."""
    rows, model = _assigned(spark, d)
    centres = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
                                    "cid int, cv array<double>")
    vec = rows.drop("features").withColumn("_vec", F.array(*FEATURES)).withColumnRenamed("cluster", "given")
    near = K.nearest_center(vec, "_vec", centres)
    used = near.agg(F.count_distinct("given").alias("n")).scalar()
    return near.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("given") != F.col("cluster")).alias("n_not_nearest")
                                     ).select("split", "n", used.alias("n_clusters"), "n_not_nearest")


# ------------------------------------------------------------- deterministic k-means
LLOYD_KS = range(2, 7)
LLOYD_STEPS = 5


def _seeded_runs(scaled: DataFrame) -> DataFrame:
    """For every k the first k train rows in md5('42|key') order."""
    seeds = subs_centres(scaled, max(LLOYD_KS))
    runs = F.explode(F.lit(list(LLOYD_KS))).alias("run")
    return seeds.select(runs, F.col("cid").cast("int").alias("cid"), "cv").where(F.col("cid") < F.col("run"))


def _lloyd(spark, d):
    scaled = subs_scaled(spark, d).withColumn("_vec", F.array(*FEATURES))
    train = scaled.where(F.col("split") == "train")
    return scaled, train, L.lloyd(train, "_vec", len(FEATURES), _seeded_runs(scaled), LLOYD_STEPS, tolerance=-1.0)


def _lloyd_cte() -> str:
    """Every step written out: centres, nearest centres, means."""
    dist = ("list_reduce(list_transform(range(1, len(cv) + 1), lambda i: (x[i] - cv[i]) * (x[i] - cv[i])), "
            "lambda a, b: a + b)")
    means = ", ".join(f"round(avg(x[{i + 1}]), 9)" for i in range(len(FEATURES)))
    ks = ", ".join(f"({k})" for k in LLOYD_KS)
    sql = _SUBS_K + f""",
pts AS MATERIALIZED (SELECT c_custkey, split, [{', '.join(f'CAST({c} AS DOUBLE)' for c in FEATURES)}] AS x FROM scaled),
seed AS (SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY md5('42|' || CAST(c_custkey AS VARCHAR)), c_custkey) - 1
                               AS INTEGER) AS cid, x AS cv FROM pts WHERE split = 'train') WHERE cid < {max(LLOYD_KS)}),
c0 AS MATERIALIZED (SELECT CAST(run AS INTEGER) AS run, cid, cv FROM seed, (VALUES {ks}) AS t(run) WHERE cid < run)"""
    for i in range(LLOYD_STEPS + 1):
        sql += f""",
a{i} AS MATERIALIZED (SELECT c_custkey, run, cid, d, x FROM (
  SELECT c_custkey, x, run, cid, d, row_number() OVER (PARTITION BY c_custkey, run ORDER BY d, cid) AS rn
  FROM (SELECT c_custkey, x, run, cid, round({dist}, 9) AS d FROM pts, c{i} WHERE split = 'train')) WHERE rn = 1),
s{i} AS MATERIALIZED (SELECT run, cid, count(*) AS n, sum(d) AS inertia, [{means}] AS mean FROM a{i} GROUP BY run, cid),
c{i + 1} AS MATERIALIZED (SELECT c.run, c.cid, coalesce(mean, cv) AS cv FROM c{i} c LEFT JOIN s{i} s ON c.run = s.run AND c.cid = s.cid)"""
    return sql


_LLOYD = _lloyd_cte()


@query("k1_lloyd_steps", W(_LLOYD, "\nUNION ALL\n".join(
    f"SELECT c.run AS k, {i} AS step, c.cid AS cluster, coalesce(n, 0) AS n, round(coalesce(inertia, 0.0), 6) + 0.0 AS inertia "
    f"FROM c{i} c LEFT JOIN s{i} s ON c.run = s.run AND c.cid = s.cid" for i in range(LLOYD_STEPS + 1))))
def k1_lloyd_steps(spark, d):
    """Size and inertia of every cluster at every step, for each k of the elbow."""
    steps = _lloyd(spark, d)[2].steps
    return steps.select(F.col("run").alias("k"), "step", F.col("cid").alias("cluster"), "n", r6("inertia").alias("inertia"))


@query("k2_silhouette_exact", W(_LLOYD + f""",
pairs AS MATERIALIZED (
  SELECT a.c_custkey AS i, b.c_custkey AS j, list_reduce(list_transform(range(1, len(a.x) + 1), lambda q: (a.x[q] - b.x[q]) * (a.x[q] - b.x[q])),
         lambda u, v: u + v) AS d2 FROM pts a, pts b WHERE a.split = 'train' AND b.split = 'train' AND a.c_custkey <> b.c_custkey),
lab AS MATERIALIZED (SELECT c_custkey, run, cid FROM a{LLOYD_STEPS}),
away AS (SELECT li.run, p.i, li.cid AS own, lj.cid AS other, avg(d2) AS mean FROM pairs p
         JOIN lab li ON li.c_custkey = p.i JOIN lab lj ON lj.c_custkey = p.j AND lj.run = li.run GROUP BY 1, 2, 3, 4),
ab AS (SELECT run, i, max(mean) FILTER (own = other) AS a, min(mean) FILTER (own <> other) AS b FROM away GROUP BY run, i),
sil AS (SELECT l.run, count(*) AS n, avg(CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS s
        FROM lab l LEFT JOIN ab ON ab.run = l.run AND ab.i = l.c_custkey GROUP BY l.run)""", """
SELECT run AS k, n, round(s, 6) + 0.0 AS silhouette,
       run = (SELECT run FROM sil ORDER BY round(s, 9) DESC, run LIMIT 1) AS chosen FROM sil"""))
def k2_silhouette_exact(spark, d):
    """Silhouette of the clusters of each k, and the k that it chooses; the twin averages over all pairs of rows."""
    _, train, fit = _lloyd(spark, d)
    res = materialize(L.silhouette(train, "_vec", len(FEATURES), fit.centres), "silhouette")
    best = res.agg(F.min_by("run", F.struct(-F.round("silhouette", 9), F.col("run"))).alias("_best"))
    return res.select(F.col("run").alias("k"), "n", r6("silhouette").alias("silhouette"), (F.col("run") == best.scalar()).alias("chosen"))


@query("k3_lloyd_assign", W(_LLOYD, f"""
SELECT c_custkey, cid AS cluster, d AS distance FROM (
  SELECT c_custkey, cid, d, row_number() OVER (PARTITION BY c_custkey ORDER BY d, cid) AS rn FROM (
    SELECT c_custkey, cid, round(list_reduce(list_transform(range(1, len(cv) + 1), lambda i: (x[i] - cv[i]) * (x[i] - cv[i])),
                                             lambda a, b: a + b), 6) + 0.0 AS d
    FROM pts, c{LLOYD_STEPS} WHERE run = {N_CENTRES})) WHERE rn = 1"""))
def k3_lloyd_assign(spark, d):
    """Every row, train and test, with its cluster after the last step."""
    scaled, _, fit = _lloyd(spark, d)
    near = K.nearest_center(scaled, "_vec", fit.centres.where(F.col("run") == N_CENTRES), decimals=6)
    return near.select("c_custkey", "cluster", F.col("distance"))
