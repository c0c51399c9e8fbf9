"""Centroid clustering of integer vectors with geometric drift tightening.

Every vector has an upper bound of the distance to its centroid and a lower bound of the distance to
any other. After centroids have moved, the upper bound grows by its centroid's drift. The lower bound
would shrink by the largest drift; how much it has to is found per cluster instead. All vectors of a
cluster lie in a sphere around its old centre, with the largest upper bound as radius. In the plane
through that centre, another centroid's old place a and its new place b, the sphere is a disc.
For x in it, the distance to the centroid falls by at most ``|b - a| * cos(angle between b - a and x - a)``,
since that angle only grows on the way from a to b; and the angle is at least that of the centre
less the disc's half angle as seen from a. The bound may also be negative: then lower bounds rise.

A vector whose upper bound stays below its lower bound keeps its centroid. For others the distance to
their own centroid is computed; those that are still ambiguous are compared with every centroid. All
comparisons are exact: components are integers, squared distances integers as well, and bounds
have a margin far above the error of their floating-point numbers.

Vectors are packed by ``PACK`` into rows and stored in buckets of packs. A round joins them with the packs' bounds,
stored in the same buckets, so vectors are not shuffled; it writes the new bounds, and per task a
row of sums, which are added up exactly in two steps. Only sums per cluster reach the driver.

Defined results: vectors null, of another length or with a null or non-finite component take no
part; a null id is clustered but never seeds; repeated rows are clustered each; fewer vectors than centroids
give as many centroids; an empty table gives no rows. A squared distance or inertia beyond BIGINT is null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlake.llm.arrow import ship
from batchlake.session import materialize, run_dir

#: Vectors of a pack; packs of a bucket (at 64 components 8 to 64 MB).
PACK, BUCKET = 64, 8192
#: Components up to this size are computed in 64-bit integers, which hold the squared distance of
#: any two vectors of up to 128 of them; larger ones in Python's.
SMALL = 1 << 27
#: Margins of bounds: relative, and of angles.
MARGIN, ANGLE = 1e-9, 1e-7
#: Lanes of the first step of adding sums.
LANES = 64

_ASSIGNED = "vec_id bigint, cluster int, distance bigint"
_BOUNDS = "pack bigint, cluster binary, upper binary, lower binary, sums string"


@dataclass
class Clusters:
    """``assigned``: vec_id, cluster and distance (squared) of each vector. ``centroids``: the final ones.
    ``scanned``: vectors compared with every centroid, by round."""

    assigned: DataFrame
    centroids: list[list[int]] = field(default_factory=list)
    scanned: list[int] = field(default_factory=list)


def whole(value: float, scale: int) -> int:
    """floor(scale * value), also beyond the range of floating-point numbers."""
    return int(value) * scale if abs(value) >= 2.0**53 else math.floor(value * scale)


def to_integers(values: np.ndarray, scale: int) -> np.ndarray:
    """Scaled and floored components: 64-bit integers if all are small, else Python's."""
    if not values.size or np.abs(values).max() * scale < SMALL:
        return np.floor(values * scale).astype(np.int64)
    return np.array([whole(x, scale) for x in values.ravel().tolist()], dtype=object).reshape(values.shape)


def _packed(vectors: np.ndarray) -> tuple[str, bytes]:
    """Vectors as bytes, in the narrowest kind that holds them."""
    if vectors.dtype == object:
        return "text", ",".join(map(str, vectors.ravel())).encode()
    most = int(np.abs(vectors).max(initial=0))
    kind = "<i2" if most < 1 << 15 else "<i4"
    return kind, vectors.astype(kind).tobytes()


def _unpacked(kinds: list[str], data: list[bytes], size: int) -> np.ndarray:
    if "text" in kinds:
        parts = [
            [int(x) for x in d.split(b",")] if k == "text" else np.frombuffer(d, k).tolist()
            for k, d in zip(kinds, data, strict=True)
        ]
        return np.array([x for p in parts for x in p], dtype=object).reshape(-1, size)
    if len(set(kinds)) == 1:
        return np.frombuffer(b"".join(data), kinds[0]).astype(np.int64).reshape(-1, size)
    return np.concatenate([np.frombuffer(d, k).astype(np.int64) for k, d in zip(kinds, data, strict=True)]).reshape(-1, size)


def _exact(centroids: list[list[int]], vectors: np.ndarray) -> np.ndarray:
    """Centroids in a kind that keeps differences to ``vectors`` exact."""
    if vectors.dtype != object and all(abs(x) < SMALL for c in centroids for x in c):
        return np.array(centroids, dtype=np.int64)
    return np.array(centroids, dtype=object)


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = vectors - centroid
    return (apart * apart).sum(axis=1)


def _root(squares: np.ndarray) -> np.ndarray:
    """Square roots as floating-point numbers; infinite beyond their range."""
    if squares.dtype != object:
        return np.sqrt(squares.astype(np.float64))
    return np.array([float(math.isqrt(s)) if s < 1 << 1000 else math.inf for s in squares])


def _span(a: list[int], b: list[int]) -> float:
    return float(_root(np.array([sum((x - y) ** 2 for x, y in zip(a, b, strict=True))], dtype=object))[0]) * (1 + MARGIN)


def loosening(centre: list[int], radius: float, a: list[int], b: list[int]) -> float:
    """The most by which the distance to a centroid that moves from ``a`` to ``b`` falls for any point
    in the sphere; negative if it rises for all."""
    if a == b:
        return 0.0
    drift, away = _span(a, b), _span(a, centre)
    if not (math.isfinite(drift) and radius * (1 + MARGIN) < away < math.inf):
        return drift
    along = sum((p - x) * (y - x) for p, x, y in zip(centre, a, b, strict=True)) / (drift * away)
    angle = math.acos(max(-1.0, min(1.0, along))) - math.asin(min(1.0, radius * (1 + 3 * MARGIN) / away))
    tight = math.cos(max(0.0, angle - ANGLE))
    return drift * tight if tight > 0 else drift * (1 - 3 * MARGIN) * tight


@dataclass
class _Move:
    """What a round has to know: centroids, the drift of each, and by how much lower bounds of its
    vectors fall."""

    centroids: list[list[int]]
    drift: np.ndarray
    fall: np.ndarray

    def bounds(self, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(invalid="ignore"):
            upper = (upper + self.drift[cluster]) * (1 + MARGIN)
            fall = self.fall[cluster]
            lower = lower - fall - MARGIN * (np.abs(lower) + np.abs(fall))
        return upper, lower


def _move(old: list[list[int]], new: list[list[int]], radius: list[float]) -> _Move:
    k = len(new)
    drift = np.array([_span(a, b) for a, b in zip(old, new, strict=True)])
    fall = np.array(
        [max((loosening(old[i], radius[i], old[j], new[j]) for j in range(k) if j != i), default=0.0) for i in range(k)]
    )
    return _Move(new, drift, fall)


def assign(
    vectors: np.ndarray, move: _Move, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """New clusters and bounds, and how many vectors were compared with every centroid."""
    centroids = _exact(move.centroids, vectors)
    upper, lower = move.bounds(cluster, upper, lower)
    cluster = cluster.copy()
    open_ = np.flatnonzero(~(upper < lower))
    if len(open_):
        own = _root(squared(vectors[open_], centroids[cluster[open_]])) * (1 + MARGIN)
        upper[open_] = np.minimum(upper[open_], own)
        open_ = open_[~(upper[open_] < lower[open_])]
    if len(open_):
        apart = np.stack([squared(vectors[open_], c) for c in centroids], axis=1)
        near = apart.argmin(axis=1)  # the first, so the smaller number, of equals
        rows = np.arange(len(open_))
        cluster[open_] = near
        upper[open_] = _root(apart[rows, near]) * (1 + MARGIN)
        if len(centroids) > 1:
            apart[rows, near] = apart.max(axis=1) + 1
            lower[open_] = _root(apart.min(axis=1)) * (1 - MARGIN)
        else:
            lower[open_] = np.inf
    return cluster, upper, lower, len(open_)


class _Sums:
    """Exact sums of a task's vectors by cluster, with their number and largest upper bound."""

    def __init__(self, k: int, size: int):
        self.n, self.radius, self.scanned = [0] * k, [0.0] * k, 0
        self.total = [[0] * size for _ in range(k)]

    def add(self, vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray) -> None:
        for c in np.unique(cluster).tolist():
            mine = cluster == c
            self.n[c] += int(mine.sum())
            self.radius[c] = max(self.radius[c], float(upper[mine].max()))
            self.total[c] = [a + b for a, b in zip(self.total[c], vectors[mine].sum(axis=0).tolist(), strict=True)]

    def merge(self, text: str) -> None:
        n, radius, scanned, total = text.split(";")
        self.n = [a + int(b) for a, b in zip(self.n, n.split(","), strict=True)]
        self.radius = [max(a, float(b)) for a, b in zip(self.radius, radius.split(","), strict=True)]
        self.scanned += int(scanned)
        flat = iter(total.split(","))
        self.total = [[a + int(next(flat)) for a in row] for row in self.total]

    def __str__(self) -> str:
        flat = ",".join(str(x) for row in self.total for x in row)
        return f"{','.join(map(str, self.n))};{','.join(map(repr, self.radius))};{self.scanned};{flat}"


def _pack(kept: DataFrame, scale: int, size: int) -> DataFrame:
    """Packs of vectors: ids, and scaled components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            column = batch.column("embedding")
            values = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, size)
            ids = batch.column("vec_id").to_pylist()
            rows = []
            for begin in range(0, len(ids), PACK):
                rows.append((number, ids[begin : begin + PACK], *_packed(to_integers(values[begin : begin + PACK], scale))))
                number += 1
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.string(), pa.binary())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["pack", "ids", "kind", "data"])

    return kept.mapInArrow(run, "pack bigint, ids array<bigint>, kind string, data binary")


class _Store:
    """Stored tables in the same buckets of packs."""

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets, self.names = spark, buckets, []

    def write(self, frame: DataFrame, label: str, deal: bool = True) -> DataFrame:
        """``frame`` as a table; ``deal`` if its tasks do not hold a bucket each."""
        path = run_dir(self.spark, label)
        name = path.rsplit("/", 1)[1].replace("-", "_")
        if deal:
            frame = frame.repartition(self.buckets, "pack")
        frame.write.format("parquet").option("path", path).bucketBy(self.buckets, "pack").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def forget(self) -> None:
        """Drop the names; the files stay where they are, in the shared folder."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def seeds(kept: DataFrame, k: int, scale: int, salt: str) -> list[list[int]]:
    """The first centroids: vectors of the ``k`` least digests of ``salt:vec_id``."""
    mark = F.sha2(F.concat(F.lit(salt + ":"), F.col("vec_id").cast("string")), 256)
    rows = (
        kept.where("vec_id IS NOT NULL").select(mark.alias("mark"), "embedding").orderBy("mark", "embedding").limit(k).collect()
    )
    return [[whole(float(x), scale) for x in r["embedding"]] for r in rows]


def _round(packs: DataFrame, bounds: DataFrame | None, move: _Move, size: int) -> DataFrame:
    """New bounds of all packs, and a row of sums per task."""
    k, fresh = len(move.centroids), bounds is None
    if fresh:
        joined = packs.select("pack", "kind", "data", F.size("ids").alias("n"))
    else:
        known = bounds.where("sums IS NULL").select("pack", "cluster", "upper", "lower").hint("shuffle_hash")
        joined = packs.select("pack", "kind", "data").join(known, "pack")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(k, size)
        names = ["pack", "cluster", "upper", "lower", "sums"]
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds, data = batch.column("kind").to_pylist(), batch.column("data").to_pylist()
            vectors = _unpacked(kinds, data, size)
            if fresh:
                counts = batch.column("n").to_numpy()
                total = int(counts.sum())
                cluster = np.zeros(total, dtype=np.int64)
                upper, lower = np.full(total, np.inf), np.full(total, -np.inf)
            else:
                parts = batch.column("cluster").to_pylist()
                counts = np.array([len(p) // 4 for p in parts])
                cluster = np.frombuffer(b"".join(parts), "<i4").astype(np.int64)
                upper, lower = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<f8") for c in ("upper", "lower"))
            cluster, upper, lower, scanned = assign(vectors, move, cluster, upper, lower)
            sums.scanned += scanned
            sums.add(vectors, cluster, upper)
            ends = np.cumsum(counts).tolist()
            begins = [0, *ends[:-1]]
            columns = [
                [v[b:e].astype(t).tobytes() for b, e in zip(begins, ends, strict=True)]
                for v, t in ((cluster, "<i4"), (upper, "<f8"), (lower, "<f8"))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("pack"), *(pa.array(c, pa.binary()) for c in columns), pa.nulls(len(ends), pa.string())],
                names,
            )
        if any(sums.n):
            own = [-1 - TaskContext.get().partitionId()]
            none = pa.nulls(1, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(own), none, none, none, pa.array([str(sums)])], names)

    return joined.mapInArrow(run, _BOUNDS)


def _total(bounds: DataFrame, k: int, size: int) -> _Sums:
    """The tasks' sums, added in lanes and then on the driver: ``LANES`` rows."""

    def add(key: tuple, table: pa.Table) -> pa.Table:
        sums = _Sums(k, size)
        for text in table.column("sums").to_pylist():
            sums.merge(text)
        return pa.table({"sums": [str(sums)]})

    found = _Sums(k, size)
    rows = bounds.where("sums IS NOT NULL").select("pack", "sums")
    for row in rows.groupBy(F.pmod("pack", F.lit(LANES))).applyInArrow(add, "sums string").collect():
        found.merge(row["sums"])
    return found


def _finish(packs: DataFrame, bounds: DataFrame, centroids: list[list[int]], size: int) -> DataFrame:
    """Each vector's cluster and squared distance."""
    known = bounds.where("sums IS NULL").select("pack", "cluster").hint("shuffle_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _unpacked(batch.column("kind").to_pylist(), batch.column("data").to_pylist(), size)
            cluster = np.frombuffer(b"".join(batch.column("cluster").to_pylist()), "<i4")
            apart = squared(vectors, _exact(centroids, vectors)[cluster])
            distance = pa.array([x if x < 1 << 63 else None for x in apart.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids").flatten(), pa.array(cluster), distance], ["vec_id", "cluster", "distance"]
            )

    return packs.join(known, "pack").mapInArrow(run, _ASSIGNED)


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, salt: str = "3"
) -> Clusters:
    """Cluster ``vectors(vec_id, embedding)`` of ``size`` components, scaled and floored.

    Each round assigns every vector to its nearest centroid (ties: the smaller number) and moves the
    centroids to the floored means; empty ones stay. Then vectors are assigned once more.
    """
    spark = vectors.sparkSession
    ship(spark)
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
    kept = kept.where((F.size("embedding") == size) & good)
    centroids = seeds(kept, k, scale, salt)
    if not centroids:
        return Clusters(spark.createDataFrame([], _ASSIGNED))
    k = len(centroids)
    store = _Store(spark, max(spark.sparkContext.defaultParallelism, kept.count() // (PACK * BUCKET)))
    packs = store.write(_pack(kept, scale, size), "cluster-packs")
    move, bounds, scanned = _Move(centroids, np.zeros(k), np.zeros(k)), None, []
    for _ in range(rounds):
        bounds = store.write(_round(packs, bounds, move, size), "cluster-bounds", bounds is None)
        sums = _total(bounds, k, size)
        scanned.append(sums.scanned)
        moved = [[x // m for x in row] if m else c for row, m, c in zip(sums.total, sums.n, centroids, strict=True)]
        move, centroids = _move(centroids, moved, sums.radius), moved
    bounds = store.write(_round(packs, bounds, move, size), "cluster-bounds", bounds is None)
    scanned.append(_total(bounds, k, size).scanned)
    assigned = materialize(_finish(packs, bounds, centroids, size), "cluster-rows")
    store.forget()
    return Clusters(assigned, centroids, scanned)


def with_inertia(found: Clusters) -> DataFrame:
    """Each vector with the distances summed over its cluster and over all, and its centroid's digest."""
    wide = F.col("distance").cast("decimal(38,0)")
    # A sum is null if a distance is.
    total = F.when(F.count(F.lit(1)) == F.count("distance"), F.sum(wide))
    sums = {r["cluster"]: r["total"] for r in found.assigned.groupBy("cluster").agg(total.alias("total")).collect()}
    whole_ = None if None in sums.values() else sum(sums.values())

    def long(value) -> int | None:
        return None if value is None or value >= 1 << 63 else int(value)

    rows = [
        (c, long(sums.get(c, 0)), long(whole_), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest())
        for c, x in enumerate(found.centroids)
    ]
    each = found.assigned.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return found.assigned.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", *each.columns[1:])
