"""Deterministic k-means from given centres, and the silhouette in closed form (K1-K3).

Lloyd's steps run as a driver loop over a table of centres (runs x k rows).  A
step is one pass over the points: Arrow batches find every point's nearest centre in
each run and leave sums per (run, cluster), which Spark adds up; the means
are the next centres.  Several runs (one per k of an elbow, say) share the pass.

Means are rounded to nine decimals, so that the order in which partial sums
arrive does not add up over the steps, and ties go to the lowest cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from churnlab.operators.cluster import sq_distance
from churnlab.session import materialize

DECIMALS = 9
#: Points of a written part: the steps compute far more than they read, so parts are small.
POINTS = 50_000


@dataclass
class Lloyd:
    """``centres``: (run, cid, cv) after the last step; ``steps``: (run, step,
    cid, n, inertia), what the centres of each step hold, step 0 being the given ones."""
    centres: DataFrame
    steps: DataFrame


def _points(points: DataFrame, vec_col: str, dims: int) -> DataFrame:
    """``_x`` of the points that take part, written once: every pass reads vectors and
    does not make them again of the columns they come from."""
    vec = F.col(vec_col).cast("array<double>")
    points = points.where(F.size(vec) == dims).select(vec.alias("_x"))
    return materialize(points.repartition(max(8, -(-points.count() // POINTS))), "lloyd-points")


def _runs(centres: DataFrame) -> dict:
    """{run: [(cid, cv)] by cid}: parameters of the fit, not data."""
    runs: dict = {}
    for r in sorted(centres.select("run", "cid", "cv").collect(), key=lambda r: (r.run, r.cid)):
        runs.setdefault(r.run, []).append((r.cid, r.cv))
    return runs


def _vectors(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The points of a batch as rows, and which of their numbers are null (0 there)."""
    numbers = batch.column(0).flatten()
    holes = numbers.is_null().to_numpy(zero_copy_only=False).reshape(-1, dims)
    return numbers.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, dims), holes


def _nearest(x: np.ndarray, void: np.ndarray, centres: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest centre and the squared distance, rounded, null (NaN) for points with
    a null; those, and all points where a centre is no such vector, fall to the lowest without a distance."""
    dims = x.shape[1]
    odd = [i for i, (_, cv) in enumerate(centres) if cv is None or len(cv) != dims or None in cv]
    if odd:
        return np.full(len(x), odd[0]), np.full(len(x), np.nan)
    ds = []
    for _, cv in centres:
        d = np.zeros(len(x))
        for i, c in enumerate(cv):  # left to right, as sq_distance
            d += (x[:, i] - c) * (x[:, i] - c)
        scaled = d * 10.0 ** DECIMALS
        ds.append(np.where(scaled < 2.0 ** 52, np.floor(scaled + 0.5) / 10.0 ** DECIMALS, d))
    d = np.stack(ds, axis=1)
    at = np.where(np.isnan(d), np.inf, d).argmin(axis=1)
    return np.where(void, 0, at), np.where(void, np.nan, d[np.arange(len(x)), at])


def _types(centres: DataFrame) -> list[str]:
    return [centres.schema[c].dataType.simpleString() for c in ("run", "cid")]


def _sums(points: DataFrame, centres: DataFrame, dims: int) -> DataFrame:
    """(run, cid, n, inertia, s, m, q) of the points that each centre is nearest to: their number, sum
    of distances, sum and number of each coordinate, and sum of squared lengths.  Centres without points are missing."""
    runs = _runs(centres)
    run, cid = _types(centres)
    names = ["run", "cid", "n", "inertia", "s", "m", "q"]
    kinds = f"run {run}, cid {cid}, n bigint, inertia double, s array<double>, m array<bigint>, q double"

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, holes = _vectors(batch, dims)
            void = holes.any(axis=1)
            square = np.where(void, 0.0, (x * x).sum(axis=1))
            rows = []
            for r, centres in runs.items():
                at, d = _nearest(x, void, centres)
                for k in np.unique(at).tolist():
                    mine = at == k
                    rows.append((r, centres[k][0], int(mine.sum()), float(np.nansum(d[mine])), x[mine].sum(axis=0).tolist(),
                                 (~holes[mine]).sum(axis=0).tolist(), float(square[mine].sum())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], names)

    schema = to_arrow_schema(points.sparkSession.createDataFrame([], kinds).schema)
    found = points.mapInArrow(parts, kinds)
    return found.groupBy("run", "cid").agg(
        F.sum("n").alias("n"), F.sum("inertia").alias("inertia"),
        *[F.array(*[F.sum(F.get(c, F.lit(i))) for i in range(dims)]).alias(c) for c in ("s", "m")], F.sum("q").alias("q"))


def lloyd(points: DataFrame, vec_col: str, dims: int, centres: DataFrame, max_steps: int = 20,
          tolerance: float = 1e-6) -> Lloyd:
    """K1/K3: steps from ``centres`` (run, cid, cv) until no centre moves by more
    than ``tolerance`` (Euclidean), ``max_steps`` at most.

    Points with a null vector, or one of another length than ``dims``, are left
    out.  A centre that no point is nearest to stays where it is.  The table of
    centres is written each step, so that a lost executor costs one step's tasks.
    """
    points = _points(points, vec_col, dims)
    centres = materialize(centres.select("run", "cid", F.col("cv").cast("array<double>").alias("cv")), "lloyd-centres")
    steps = None
    for step in range(max_steps + 1):
        sums = _sums(points, centres, dims).select(
            F.col("run").alias("r"), F.col("cid").alias("c"), "n", "inertia",
            F.array(*[F.round(F.try_divide(F.get("s", F.lit(i)), F.get("m", F.lit(i))), DECIMALS) for i in range(dims)]).alias("mean"))
        moved = centres.join(sums, (F.col("run") == F.col("r")) & (F.col("cid") == F.col("c")), "left").select(
            "run", "cid", F.coalesce("mean", "cv").alias("cv"), F.coalesce("n", F.lit(0)).alias("n"),
            F.coalesce("inertia", F.lit(0.0)).alias("inertia"),
            (F.sqrt(sq_distance(F.col("cv"), F.coalesce("mean", "cv"))) > tolerance).alias("moved"))
        moved = materialize(moved, "lloyd-step")
        now = moved.select("run", F.lit(step).alias("step"), "cid", "n", "inertia")
        steps = now if steps is None else steps.unionByName(now)
        if step == max_steps or moved.where("moved").isEmpty():
            break
        centres = moved.select("run", "cid", "cv")
    return Lloyd(centres, steps)


def silhouette(points: DataFrame, vec_col: str, dims: int, centres: DataFrame) -> DataFrame:
    """K2: (run, n, silhouette) of the clusters that ``centres`` make, by squared
    Euclidean distance.

    The mean squared distance of x to a cluster of n points with vector sum s
    and sum of squared lengths q is |x|^2 - 2 x.s / n + q / n, so two passes
    over the points do: one for (n, s, q) per cluster, one for the mean over
    the points.  A point alone in its cluster counts as 0, and so do all points of a
    run with a single cluster.
    """
    points = _points(points, vec_col, dims)
    runs = _runs(centres)
    stats = {(r.run, r.cid): (r.n, np.array(r.s, float), r.q) for r in _sums(points, centres, dims).collect()}  # runs x k rows
    run = _types(centres)[0]

    def scores(x: np.ndarray, void: np.ndarray, r, centres: list[tuple]) -> np.ndarray:
        at, _ = _nearest(x, void, centres)
        held = [(k, *stats[r, cid]) for k, (cid, _) in enumerate(centres) if (r, cid) in stats]
        if len(held) < 2:
            return np.zeros(len(x))
        square = (x * x).sum(axis=1)
        mean = np.stack([square + (q - 2.0 * (x @ s)) / n for _, n, s, q in held], axis=1)
        place, sizes = np.array([k for k, *_ in held]), np.array([n for _, n, *_ in held], float)
        own, rows = np.searchsorted(place, at), np.arange(len(x))
        # the point itself is no neighbour of its own
        n = sizes[own]
        a = np.maximum(mean[rows, own], 0.0) * n / np.maximum(n - 1, 1)
        mean[rows, own] = np.inf
        b = np.maximum(mean.min(axis=1), 0.0)
        most = np.maximum(a, b)
        return np.where((n < 2) | (most == 0) | void, 0.0, (b - a) / np.where(most == 0, 1.0, most))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, holes = _vectors(batch, dims)
            if len(x):
                void = holes.any(axis=1)
                found = [(r, len(x), float(scores(x, void, r, cs).sum())) for r, cs in runs.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), schema.types, strict=True)],
                                                 ["run", "n", "s"])

    kinds = f"run {run}, n bigint, s double"
    schema = to_arrow_schema(points.sparkSession.createDataFrame([], kinds).schema)
    return points.mapInArrow(parts, kinds).groupBy("run").agg(F.sum("n").alias("n"), (F.sum("s") / F.sum("n")).alias("silhouette"))
