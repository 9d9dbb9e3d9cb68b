"""Clusters of vectors by exact integer k-means that scans only vectors whose bounds leave a doubt.

Vectors become integer vectors and lie in blocks. A vector carries an upper bound on the distance to its centroid and a
lower bound on that to all others. When centroids move, a cluster is a sphere around its old centroid. How much nearer
a moved centroid can come to any point of a sphere follows from the angle between its path and the direction to the
sphere, in the plane of the path and the sphere's centre: seldom the whole drift, and less than nothing where it moves
away. Vectors whose bounds still part after that keep their cluster; all others are compared with every centroid in
whole numbers, so that bounds never decide a tie.

Blocks are written once, dealt out by their number. A round reads them beside the bounds of the round before, which
are dealt out alike, writes new bounds, and adds up only the vectors that changed their cluster. The driver holds the
centroids, a table of ``clusters`` rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinfold.llm.common import kept_struct, parts, stage, stage_by, with_kept

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
#: Vectors of a block, and blocks that a part of the table holds at most on average.
BLOCK = 4096
BLOCKS = 64
#: Below this squared length all distances between vectors are whole numbers of 63 bits.
SHORT = 1 << 60
#: Longer ones are summed in two halves, each within 38 digits.
HALF = 1 << 64
FAR = 2.0**32
#: What bounds have to differ by to count, far above the rounding of a distance.
SLACK = 1e-3
#: Parts of a centroid's path that are looked at one by one.
STEPS = 4


def loosening(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """How much nearer a centroid can come, on its way from ``old`` to ``new``, to any point of a sphere.

    A point is approached at the cosine of the angle between the path and the direction to the point. In the plane of
    the path and the centre, the centre is seen at an angle that only grows on the way, and no point of the sphere
    deviates from it by more than the sphere's half angle of sight. Negative where the centroid leaves all points.
    """
    path = new - old
    drift = float(np.sqrt(path @ path))
    if drift == 0:
        return 0.0
    total = 0.0
    for step in range(STEPS):
        to_centre = centre - (old + path * (step / STEPS))
        away = float(np.sqrt(to_centre @ to_centre))
        at = min(max(float(to_centre @ path) / drift**2, 0.0), 1 / STEPS)
        beside = to_centre - at * path
        nearest = float(np.sqrt(beside @ beside))
        if nearest <= radius:
            total += drift / STEPS
            continue
        seen = math.acos(min(1.0, max(-1.0, float(to_centre @ path) / (away * drift))))
        total += drift / STEPS * math.cos(max(0.0, seen - math.asin(radius / nearest)))
    return min(drift, total + 1e-7 * drift)


@dataclass(frozen=True)
class Move:
    """Centroids of a round, the drift of each since the last one, and what it takes from its vectors' lower bounds."""

    centroids: list[list[int]]
    drift: list[float]
    loose: list[float]

    @classmethod
    def between(cls, old: list[list[int]], new: list[list[int]], radius: list[float]) -> Move:
        a, b = np.array(old, np.float64), np.array(new, np.float64)
        drift = np.sqrt(((a - b) ** 2).sum(axis=1))
        loose = [
            max((loosening(a[c], radius[c], a[j], b[j]) for j in range(len(a)) if j != c), default=0.0)
            for c in range(len(a))
        ]
        return cls(new, drift.tolist(), loose)


def _whole(x: float, scale: int) -> int:
    """floor(scale * x), also where the product is no double."""
    return math.floor(x * scale) if abs(x) < 2.0**52 else int(x) * scale


def _packer(size: int, scale: int):
    """Rows (vec, kept) to blocks: keys, whole numbers of 32 bits, or the doubles where a vector is too long (far)."""

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in rows:
            x = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(x * scale)
                short = (whole * whole).sum(axis=1) < SHORT
            for far, which in ((False, np.nonzero(short)[0]), (True, np.nonzero(~short)[0])):
                for i in range(0, len(which), BLOCK):
                    some = which[i : i + BLOCK]
                    keys = batch.column("kept").take(pa.array(some))
                    data = x[some].astype("<f8") if far else whole[some].astype("<i4")
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([number], pa.int64()),
                            pa.array([far]),
                            pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), keys),
                            pa.array([data.tobytes()], pa.binary()),
                        ],
                        ["block", "far", "keys", "data"],
                    )
                    number += 1

    return pack


def _vectors(data: bytes, far: bool, size: int, scale: int) -> np.ndarray:
    if not far:
        return np.frombuffer(data, "<i4").reshape(-1, size).astype(np.int64)
    x = np.frombuffer(data, "<f8")
    out = np.empty(len(x), object)
    out[:] = [_whole(v, scale) for v in x.tolist()]
    return out.reshape(-1, size)


def _distances(x: np.ndarray, centroid: list[int]) -> np.ndarray:
    """Squared distances in whole numbers."""
    far = x.dtype == object or sum(v * v for v in centroid) >= 2 * SHORT
    return ((x - np.array(centroid, object if far else np.int64)) ** 2).sum(axis=1)


def assign(x: np.ndarray, move: Move, state: tuple[np.ndarray, ...] | None) -> tuple[np.ndarray, ...]:
    """Cluster, upper and lower bound and number of scans of each vector, after the centroids moved."""
    n = len(x)
    if state is None:
        cluster, upper, lower = np.zeros(n, np.int32), np.full(n, np.inf), np.zeros(n)
        scans, open_ = np.zeros(n, np.int32), np.arange(n)
    else:
        cluster, upper, lower, scans = (a.copy() for a in state)
        upper += np.array(move.drift)[cluster]
        lower -= np.array(move.loose)[cluster]
        open_ = np.nonzero(~(upper + SLACK < lower))[0]
        if x.dtype != object:  # the true distance to the own centroid may settle it
            for c in np.unique(cluster[open_]).tolist():
                own = open_[cluster[open_] == c]
                upper[own] = np.sqrt(_distances(x[own], move.centroids[c]).astype(np.float64)) + SLACK / 4
            open_ = open_[~(upper[open_] + SLACK < lower[open_])]
    if len(open_):
        table = np.stack([_distances(x[open_], c) for c in move.centroids], axis=1)
        cluster[open_] = table.argmin(axis=1)
        scans[open_] += 1
        if x.dtype == object:
            upper[open_], lower[open_] = np.inf, 0.0
        else:
            near = np.sort(table, axis=1)[:, :2].astype(np.float64)
            upper[open_] = np.sqrt(near[:, 0]) + SLACK / 4
            # bounds far beyond all short vectors are cut, so that they stay exact to SLACK
            lower[open_] = np.minimum(np.sqrt(near[:, 1]) - SLACK / 4, FAR) if table.shape[1] > 1 else FAR
    return cluster, upper, lower, scans


_STATE = "block long, cluster binary, upper binary, lower binary, scans binary"
_KINDS = {"cluster": "<i4", "upper": "<f8", "lower": "<f8", "scans": "<i4"}


def _state(row: dict) -> tuple[np.ndarray, ...] | None:
    return None if row.get("cluster") is None else tuple(np.frombuffer(row[c], t) for c, t in _KINDS.items())


def _round(move: Move, size: int, scale: int):
    """New bounds of each block, and what its vectors that changed their cluster add to sums and counts."""
    k = len(move.centroids)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                x, before = _vectors(row["data"], row["far"], size, scale), _state(row)
                after = assign(x, move, before)
                new, upper = after[0], after[1]
                counts, sums = np.zeros(k, np.int64), np.zeros((k, size), x.dtype)
                radius = np.zeros(k)
                np.maximum.at(radius, new, upper)
                moved = np.arange(len(x)) if before is None else np.nonzero(before[0] != new)[0]
                for c in np.unique(new[moved]).tolist():
                    which = moved[new[moved] == c]
                    sums[c] += x[which].sum(axis=0)
                    counts[c] += len(which)
                if before is not None:
                    for c in np.unique(before[0][moved]).tolist():
                        which = moved[before[0][moved] == c]
                        sums[c] -= x[which].sum(axis=0)
                        counts[c] -= len(which)
                flat = [int(v) for v in sums.ravel().tolist()] if len(moved) else None
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "block": row["block"],
                            **{c: a.astype(t).tobytes() for (c, t), a in zip(_KINDS.items(), after)},
                            "low": flat and [v % HALF if row["far"] else v for v in flat],
                            "high": [v // HALF for v in flat] if flat and row["far"] else None,
                            "counts": counts.tolist(),
                            "radius": radius.tolist(),
                        }
                    ],
                    schema=_ROUND_ARROW,
                )

    return run


_ROUND = _STATE + ", low array<decimal(38,0)>, high array<decimal(38,0)>, counts array<long>, radius array<double>"
_WHOLE = pa.list_(pa.decimal128(38, 0))
_ROUND_ARROW = pa.schema(
    [("block", pa.int64())]
    + [(c, pa.binary()) for c in _KINDS]
    + [("low", _WHOLE), ("high", _WHOLE), ("counts", pa.list_(pa.int64())), ("radius", pa.list_(pa.float64()))]
)


def _last(move: Move, size: int, scale: int):
    """Cluster, distance and scans of each vector; a distance past 63 bits is null."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            keys, plain = batch.column("keys"), batch.drop_columns(["keys"]).to_pylist()
            for i, row in enumerate(plain):
                x = _vectors(row["data"], row["far"], size, scale)
                cluster, _, _, scans = assign(x, move, _state(row))
                distance = np.empty(len(x), object)
                for c in np.unique(cluster).tolist():
                    own = cluster == c
                    distance[own] = _distances(x[own], move.centroids[c])
                far = [int(d) if d < 1 << 63 else None for d in distance.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(i, 1).flatten(), pa.array(cluster), pa.array(far, pa.int64()), pa.array(scans)],
                    ["kept", "cluster", "distance", "scans"],
                )

    return run


def _usable(size: int) -> Column:
    inside = F.forall("vec", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return (F.size("vec") == size) & inside


def _literal(values: list, kind: str) -> Column:
    """The value of a row's cluster in a list of one for each cluster."""
    return F.array(*[F.lit(v).cast(kind) for v in values])[F.col("cluster")]


def cluster_vectors(
    df: DataFrame,
    column: str,
    key: str,
    *keep: str,
    size: int = 64,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """The cluster of each vector in ``column`` with exactly ``size`` components, none null, infinite or no number.

    Other rows have no result. Returns ``keep``, cluster, distance (squared, in units of 1/scale), cluster_inertia,
    inertia, centroid_sha256 and scans (how often the vector was compared with all centroids). Centroids start as the
    vectors with the least sha256 of ``seed:key``; null keys come last, equal ones by their vectors. With fewer vectors
    than ``clusters`` there are as many clusters as vectors; an empty table has none. Equal rows each have a result.
    Distances and sums past 63 bits are null; components of 10**50 and more raise an error.
    """
    spark = df.sparkSession
    rows = with_kept(df, [column, key], keep)
    rows = rows.select(F.col(column).cast("array<double>").alias("vec"), F.col(key).alias("key"), kept_struct(keep).alias("kept"))
    rows = rows.filter(_usable(size))
    counted = Observation("vectors")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    seen = rows.observe(counted, F.count(F.lit(1)).alias("n")).select(drawn.alias("drawn"), "vec")
    first = seen.orderBy(F.col("drawn").asc_nulls_last(), "vec").limit(clusters).collect()
    centroids = [[_whole(v, scale) for v in r.vec] for r in first]
    kept_type = rows.schema["kept"].dataType
    kind = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("far", T.BooleanType()),
            T.StructField("keys", T.ArrayType(kept_type)),
            T.StructField("data", T.BinaryType()),
        ]
    )
    n = max(1, -(-counted.get["n"] // (BLOCK * BLOCKS)), parts(spark))
    blocks = stage_by(rows.select("vec", "kept").mapInArrow(_packer(size, scale), kind), "block", "vectors", n)
    state, move = None, Move(centroids, [0.0] * len(centroids), [0.0] * len(centroids))
    sums = [[0] * size for _ in centroids]
    counts = [0] * len(centroids)
    for _ in range(rounds if centroids else 0):
        both = _beside(blocks.select("block", "far", "data"), state)
        state = stage_by(both.mapInArrow(_round(move, size, scale), _ROUND), "block", "bounds", n, dealt=True)
        halves = F.arrays_zip("low", F.coalesce("high", "low").alias("high"))
        add = state.filter("low is not null").select(F.posexplode(halves).alias("at", "half"), F.col("high").isNotNull().alias("far"))
        add = add.groupBy("at").agg(F.sum("half.low").alias("low"), F.sum(F.when(F.col("far"), F.col("half.high"))).alias("high"))
        for r in add.collect():  # a row for each component of each centroid
            sums[r.at // size][r.at % size] += int(r.low) + HALF * int(r.high or 0)
        of = state.select(F.posexplode(F.arrays_zip("counts", "radius")).alias("at", "of"))
        radius = [0.0] * len(centroids)
        for r in of.groupBy("at").agg(F.sum("of.counts").alias("n"), F.max("of.radius").alias("radius")).collect():
            counts[r["at"]] += r["n"]
            radius[r["at"]] = r["radius"]
        new = [[s // c for s in total] if c else old for total, c, old in zip(sums, counts, move.centroids)]
        if new == move.centroids:  # nothing will change any more
            move = Move(new, [0.0] * len(new), [0.0] * len(new))
            break
        move = Move.between(move.centroids, new, radius)
    out = T.StructType(
        [
            T.StructField("kept", kept_type),
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
            T.StructField("scans", T.IntegerType()),
        ]
    )
    found = stage(_beside(blocks, state).mapInArrow(_last(move, size, scale), out), "clustered")
    total = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    inertia: list[int | None] = [0] * len(centroids)
    for r in found.groupBy("cluster").agg(total.alias("total")).collect():  # a row for each cluster
        inertia[r.cluster] = None if r.total is None else int(r.total)
    whole = None if None in inertia else sum(inertia)
    fits = lambda v: v if v is not None and v < 1 << 63 else None
    sha = [F.sha2(F.lit(",".join(map(str, c))), 256) for c in move.centroids]
    return found.select(
        *[F.col(f"kept.kept{i}").alias(c) for i, c in enumerate(keep)],
        "cluster",
        "distance",
        _literal([fits(v) for v in inertia] or [None], "long").alias("cluster_inertia"),
        F.lit(fits(whole)).cast("long").alias("inertia"),
        F.array(*(sha or [F.lit(None).cast("string")]))[F.col("cluster")].alias("centroid_sha256"),
        "scans",
    )


def _beside(blocks: DataFrame, state: DataFrame | None) -> DataFrame:
    """Blocks with their bounds; both tables are dealt out by the block, so none of them moves."""
    if state is None:
        return blocks
    return blocks.join(state.select("block", *_KINDS), "block")

