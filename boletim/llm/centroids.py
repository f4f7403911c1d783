"""Exact nearest centroids by equal-average equal-variance search, in rounds of Lloyd's method.

With sums ``S``, norms ``D`` of what is left after the mean is taken off (times the root of the
dimension ``d``), and squared distance ``q`` of a vector and a centroid,

    d * q >= (Sx - Sc)**2 + (Dx - Dc)**2

Centroids are sorted by their sum. Each vector starts at its own sum and scans outward, nearest sum
first: once the first term alone exceeds ``d`` times the best distance, no centroid further out can be
nearer, and the scan ends; a centroid whose both terms exceed it is passed over; the distance of any
other is computed. All of it in integers, the norms rounded so that the bound stays a bound.

Tasks hold the centroids (a few thousand numbers) and return, per centroid, how many vectors are
nearest and their sum; Spark adds these up. Vectors are never shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boletim.llm.common import let_workers_import
from boletim.storage import shared_folder

DIMENSION = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
#: Vectors that are scanned at a time.
AT_ONCE = 8192
#: Components up to this size keep every product below within 63 bits; others take Python's integers.
SMALL = 1 << 22
#: Bits of a limb, in which sums travel.
LIMB = 48


def scaled(rows: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` of every component as exact integers."""
    with np.errstate(over="ignore"):
        found = np.floor(rows.astype(np.float64) * SCALE)
    if not len(found) or np.abs(found).max() < SMALL:
        return found.astype(np.int64)
    # A double that its product does not hold is a whole number.
    exact = [
        [int(y) if math.isfinite(y) else int(x) * SCALE for x, y in zip(*pair)]
        for pair in zip(rows.tolist(), found.tolist())
    ]
    return np.array(exact, dtype=object)


def _roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integer square roots, rounded down and up."""
    if squares.dtype == object:
        down = np.array([math.isqrt(x) for x in squares], dtype=object)
    else:
        down = np.sqrt(squares.astype(np.float64)).astype(np.int64)
        down -= down * down > squares
        down += (down + 1) * (down + 1) <= squares
    return down, down + (down * down < squares)


class Search:
    """The centroids in order of their sums, with what the inequalities need of them."""

    def __init__(self, centroids: list[list[int]]):
        self.d = len(centroids[0])
        large = max(abs(x) for c in centroids for x in c) >= SMALL
        self.kind = object if large else np.int64
        made = np.array(centroids, dtype=self.kind)
        order = np.argsort(made.sum(axis=1), kind="stable")
        self.number, self.rows = order, made[order]
        self.sums = self.rows.sum(axis=1)
        self.low, self.high = _roots(self.d * (self.rows * self.rows).sum(axis=1) - self.sums**2)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each row's nearest centroid, ties to the smaller number.

        Also how many distances were computed.
        """
        if rows.dtype != self.kind:
            rows = rows.astype(object)
        kind = object if object in (rows.dtype, self.kind) else np.int64
        n, k, d = len(rows), len(self.number), self.d
        sums = rows.sum(axis=1)
        low, high = _roots(d * (rows * rows).sum(axis=1) - sums * sums)
        right = np.searchsorted(self.sums, sums).astype(np.int64)
        left = right - 1
        best = np.zeros(n, kind)
        number = np.full(n, k)
        active, computed = np.arange(n), 0
        while len(active):
            l, r, s = left[active], right[active], sums[active]
            on_left = self.sums[np.maximum(l, 0)]
            on_right = self.sums[np.minimum(r, k - 1)]
            leftward = ((r >= k) | (s - on_left <= on_right - s).astype(bool)) & (l >= 0)
            c = np.where(leftward, l, r)
            apart = s - self.sums[c]
            new = number[active] == k
            most = best[active] * d
            square = apart * apart
            going = new | (square <= most).astype(bool)
            active, c, square, most, new = (x[going] for x in (active, c, square, most, new))
            side = leftward[going]
            gap = np.maximum(low[active] - self.high[c], self.low[c] - high[active])
            gap = np.maximum(gap, 0)
            measured = new | (square + gap * gap <= most).astype(bool)
            who, which = active[measured], c[measured]
            differences = rows[who] - self.rows[which]
            found = (differences * differences).sum(axis=1)
            computed += len(who)
            named = self.number[which]
            better = (number[who] == k) | (found < best[who]).astype(bool)
            better |= (found == best[who]).astype(bool) & (named < number[who])
            best[who[better]] = found[better]
            number[who[better]] = named[better]
            left[active[side]] -= 1
            right[active[~side]] += 1
            active = active[(left[active] >= 0) | (right[active] < k)]
        return number, best, computed


def _vectors(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lists have ``dimension`` finite components, and those as rows."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fits = np.flatnonzero(lengths == dimension)
    flat = column.take(pa.array(fits)).flatten().cast(pa.float64())
    rows = flat.to_numpy(zero_copy_only=False).reshape(-1, dimension)  # nulls come as NaN
    finite = np.isfinite(rows).all(axis=1)
    return fits[finite], rows[finite]


def _limbs(value: int) -> list[tuple[int, int]]:
    """Places and values of the parts of LIMB bits that are not 0, each with the sign."""
    sign, rest, found = (1, -1)[value < 0], abs(value), []
    for place in range(-(-rest.bit_length() // LIMB)):
        part = rest >> LIMB * place & ((1 << LIMB) - 1)
        if part:
            found.append((place, sign * part))
    return found


def first_centroids(
    vectors: DataFrame,
    count: int = CENTROIDS,
    key: str = "vec_id",
    vector: str = "embedding",
    dimension: int = DIMENSION,
    seed: str = "2:",
) -> list[list[int]]:
    """The scaled vectors of the smallest sha256 of ``seed`` and the key, in that order.

    A null key counts as empty text; rows of one key go by their components.
    """
    kept = vectors.where(F.size(vector) == dimension)
    kept = kept.where(
        ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    )
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    drawn = kept.select(
        F.sha2(F.concat(F.lit(seed), name), 256).alias("hash"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    rows = drawn.orderBy("hash", "vector").limit(count).collect()
    return [[int(x) for x in scaled(np.array([r["vector"]]))[0]] for r in rows]


def _summed(centroids: list[list[int]], dimension: int) -> Callable:
    """Per task: the sums of the vectors nearest to each centroid, in limbs, and as component -1
    how many there are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, k = Search(centroids), len(centroids)
        counts = [0] * k
        sums = [[0] * dimension for _ in range(k)]
        for batch in batches:
            _, values = _vectors(batch.column(0), dimension)
            for at in range(0, len(values), AT_ONCE):
                rows = scaled(values[at : at + AT_ONCE])
                number, _, _ = search.nearest(rows)
                for c in np.unique(number):
                    mine = rows[number == c]
                    counts[c] += len(mine)
                    sums[c] = [a + int(b) for a, b in zip(sums[c], mine.sum(axis=0))]
        cells = [
            (c, i, *limb)
            for c in range(k)
            for i, value in enumerate([counts[c], *sums[c]], -1)
            for limb in _limbs(value)
        ]
        columns = [pa.array([x[j] for x in cells], pa.int64()) for j in range(4)]
        yield pa.RecordBatch.from_arrays(columns, names=["c", "i", "place", "part"])

    return work


def _moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The floors of the means; a centroid without vectors stays.

    What comes to the driver has some rows per centroid and component.
    """
    d = len(centroids[0])
    out = "c bigint, i bigint, place bigint, part bigint"
    total = F.sum(F.col("part").cast("decimal(20,0)")).alias("part")
    sums: dict[tuple[int, int], int] = {}
    for r in vectors.mapInArrow(_summed(centroids, d), out).groupBy("c", "i", "place").agg(total).collect():
        cell = r["c"], r["i"]
        sums[cell] = sums.get(cell, 0) + (int(r["part"]) << LIMB * r["place"])
    return [
        [sums.get((c, i), 0) // sums[c, -1] for i in range(d)] if (c, -1) in sums else old
        for c, old in enumerate(centroids)
    ]


def _assigned(centroids: list[list[int]], dimension: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            kept, values = _vectors(batch.column(1), dimension)
            keys = batch.column(0).take(pa.array(kept))
            for at in range(0, len(values), AT_ONCE):
                number, best, _ = search.nearest(scaled(values[at : at + AT_ONCE]))
                distance = [int(x) if x < 1 << 63 else None for x in best]
                columns = [
                    keys.slice(at, len(number)),
                    pa.array(number, pa.int32()),
                    pa.array(distance, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "cluster", "distance"])

    return work


def cluster(
    vectors: DataFrame,
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    key: str = "vec_id",
    vector: str = "embedding",
    dimension: int = DIMENSION,
    folder: str | None = None,
) -> DataFrame:
    """``key, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector kept.

    Kept are vectors of ``dimension`` components, none null or non-finite; a row with another vector
    gives no row. Repeated rows are vectors of their own and a null key is kept. With fewer vectors
    than ``count`` each is a centroid; an empty table gives no rows. Other columns are not read. A
    distance or inertia beyond 63 bits is null. Assignments are written once, to ``folder`` in the
    shared space, as the sums over them are needed beside each.
    """
    spark = vectors.sparkSession
    let_workers_import(spark)
    kind = vectors.schema[key].dataType.simpleString()
    kept = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    centroids = first_centroids(kept, count, "key", "vector", dimension)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(kept.select("vector"), centroids)
    folder = folder or shared_folder(spark, "clusters")
    centroids = centroids or [[0] * dimension]
    found = kept.mapInArrow(
        _assigned(centroids, dimension), f"key {kind}, cluster int, distance bigint"
    )
    found.write.parquet(folder)
    assigned = spark.read.parquet(folder)
    # At most `count` rows come to the driver, and as many go out again.
    whole = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(whole.alias("inertia")).collect()}
    total = None if None in sums.values() else sum(map(int, sums.values()))

    def fits(value) -> int | None:
        return None if value is None or value >= 1 << 63 else int(value)

    rows = [
        (c, fits(inertia), fits(total), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c, inertia in sums.items()
    ]
    about = spark.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return assigned.join(F.broadcast(about), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
