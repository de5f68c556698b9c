"""Centroid clustering by exponion search, exact in integers.

Every vector keeps an upper bound of the distance to its centroid and a lower
bound of that to any other. As centroids move, the bounds give by the ways
moved. A vector whose upper bound is below its lower bound, or below half the way from its
centroid to the nearest other one, stays without a look at any. The others measure the distance to their
own centroid, and where that does not settle it they scan the centroids inside
a ball around their own one: its radius is twice that distance and the way to
the nearest other centroid, and whatever is nearest or second nearest to the vector lies within.
Each centroid has a list of the others sorted by distance, so the ball is the
beginning of that list. The radius is inclusive and bounds err to the
safe side, so that equally near centroids are met and the smaller number wins.

Vectors are rows of blocks (``BLOCK`` vectors a row, as narrow as their largest
component allows), made where the vectors lie: nothing is shuffled, by value or else, and a
vector that makes up a third of all is spread as its copies are. A
round is one scan: tasks move the bounds, search, and write blocks with their new bounds and their sums by centroid;
only the sums are read again, added up by centroid and component in exact
decimals. Centroids (k vectors, a parameter) pass through the driver, nothing else does.
Every round is a written table, so a lost executor costs a part of one round.

Defined results: vectors that are null, of another length, or hold a null or a value that is not finite are left out.
Repeated rows are vectors each. Ids may be null or repeat; the first centroids are those of the
smallest digests, equal ones in the order of the components. With fewer vectors than
centroids there are as few centroids, without vectors there are no rows. Components of
2^26 or more after scaling raise, as their distances need not fit in 64 bits. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.workspace import Workspace

BLOCK = 2048
SCALE, LARGEST = 1024, 1 << 26
#: Relative room for the rounding of square roots and sums of them.
ROOM = 1e-9

BLOCKS = "ids array<long>, width int, data binary, cluster binary, upper binary, lower binary, scanned long, counts array<long>, sums array<long>, inertia array<decimal(38,0)>"


@dataclass
class Centroids:
    """k centroids and what a search needs to know of them."""

    at: np.ndarray  # (k, d) integers
    moved: np.ndarray  # (k,) upper bounds of the ways moved in the last round

    def __post_init__(self) -> None:
        k = len(self.at)
        gaps = np.sqrt(np.stack([squared(self.at, c) for c in self.at]).astype(np.float64))
        np.fill_diagonal(gaps, -1)
        #: Of each centroid, itself and all others by distance, and those distances.
        self.order = np.argsort(gaps, axis=1, kind="stable")
        np.fill_diagonal(gaps, 0)
        self.gaps = np.take_along_axis(gaps, self.order, 1)
        self.nearest = self.gaps[:, 1] if k > 1 else np.full(k, np.inf)
        #: The farthest that any other centroid moved.
        rest = np.where(np.eye(k, dtype=bool), 0, self.moved[None, :])
        self.others_moved = rest.max(1)


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    gap = vectors - centroid
    return np.einsum("ij,ij->i", gap, gap)


def search(vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, c: Centroids) -> int:
    """Bring cluster and bounds up to date, in place; the number of distances that were measured."""
    upper += c.moved[cluster]
    upper *= 1 + ROOM
    lower -= c.others_moved[cluster]
    lower *= np.where(lower > 0, 1 - ROOM, 1 + ROOM)
    enough = np.maximum(lower, c.nearest[cluster] * (0.5 - ROOM))
    open_ = np.flatnonzero(upper >= enough)
    measured = len(open_)
    own = squared(vectors[open_], c.at[cluster[open_]])
    upper[open_] = np.sqrt(own) * (1 + ROOM)
    still = upper[open_] >= enough[open_]
    open_, own = open_[still], own[still]
    home = cluster[open_]
    for a in np.unique(home).tolist():
        some = np.flatnonzero(home == a)
        radius = (2 * upper[open_[some]] + c.nearest[a]) * (1 + ROOM)
        reach = np.searchsorted(c.gaps[a], radius, "right")
        by_reach = np.argsort(reach, kind="stable")
        some, reach = some[by_reach], reach[by_reach]
        rows = open_[some]
        points = vectors[rows]
        best, second = own[some], np.full(len(some), np.iinfo(np.int64).max)
        number = np.full(len(some), a, cluster.dtype)
        for j in range(1, int(reach[-1])):
            first = int(np.searchsorted(reach, j, "right"))  # rows from here on reach as far as the j-th of the list
            b = int(c.order[a, j])
            d = squared(points[first:], c.at[b])
            measured += len(d)
            wins = (d < best[first:]) | (d == best[first:]) & (b < number[first:])
            second[first:] = np.minimum(second[first:], np.where(wins, best[first:], d))
            best[first:] = np.where(wins, d, best[first:])
            number[first:] = np.where(wins, b, number[first:])
        cluster[rows], upper[rows], lower[rows] = number, np.sqrt(best) * (1 + ROOM), np.sqrt(second) * (1 - ROOM)
    return measured


def _first(vectors: np.ndarray, c: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds that rule nothing out: each vector with the first centroid, all within reach."""
    n = len(vectors)
    return np.zeros(n, np.int32), np.full(n, np.inf), np.full(n, -np.inf)


def _width(vectors: np.ndarray) -> int:
    most = max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)) - 1)
    return 2 if most < 1 << 15 else 4


def _sums(vectors: np.ndarray, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each centroid, its vectors and their sums by component."""
    counts = np.bincount(cluster, minlength=k)
    order = np.argsort(cluster, kind="stable")
    held = np.flatnonzero(counts)
    sums = np.zeros((k, vectors.shape[1]), np.int64)
    if len(held):
        sums[held] = np.add.reduceat(vectors[order], (np.cumsum(counts) - counts)[held], axis=0)
    return counts, sums


def _round(vectors: np.ndarray, state: tuple[np.ndarray, np.ndarray, np.ndarray], c: Centroids, ids: pa.Array, width: int) -> pa.RecordBatch:
    cluster, upper, lower = state
    measured = search(vectors, cluster, upper, lower, c)
    counts, sums = _sums(vectors, cluster, len(c.at))
    distance = squared(vectors, c.at[cluster])
    halves = np.zeros((2, len(c.at)), np.int64)  # a block's sum need not fit in 64 bits
    np.add.at(halves[0], cluster, distance >> 32)
    np.add.at(halves[1], cluster, distance & 0xFFFFFFFF)
    inertia = [Decimal((high << 32) + low) for high, low in zip(*halves.tolist(), strict=True)]
    cells = {
        "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        "width": pa.array([width], pa.int32()),
        "data": pa.array([vectors.astype(f"<i{width}").tobytes()], pa.binary()),
        "cluster": pa.array([cluster.tobytes()], pa.binary()),
        "upper": pa.array([upper.tobytes()], pa.binary()),
        "lower": pa.array([lower.tobytes()], pa.binary()),
        "scanned": pa.array([measured], pa.int64()),
        "counts": pa.array([counts.tolist()], pa.list_(pa.int64())),
        "sums": pa.array([sums.reshape(-1).tolist()], pa.list_(pa.int64())),
        "inertia": pa.array([inertia], pa.list_(pa.decimal128(38, 0))),
    }
    return pa.record_batch(list(cells.values()), names=list(cells))


def scaled(vectors: DataFrame, dims: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): whole vectors of dims finite components, as integers."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    whole = vectors.where(x.isNotNull() & (F.size(x) == dims) & F.coalesce(finite, F.lit(False)))
    as_integer = F.transform(x, lambda e: F.floor(e.cast("double") * SCALE))
    fits = F.forall(as_integer, lambda e: F.abs(e) < LARGEST)
    checked = F.when(fits, as_integer).otherwise(F.raise_error(F.lit("a component is too large for exact distances")).cast("array<bigint>"))
    return whole.select(F.col(id_col).cast("long").alias("vec_id"), checked.alias("v"))


def digest(seed: int, vec_id: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(vec_id.cast("string"), F.lit(""))), 256)


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest digests of seed and id."""
    found = vectors.orderBy(digest(seed, F.col("vec_id")), "v").limit(k).collect()
    return np.array([r["v"] for r in found], np.int64)


def _blocked(batches: Iterator[pa.RecordBatch], c: Centroids, dims: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(a, BLOCK)
            vectors = rows.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
            yield _round(vectors, _first(vectors, c), c, rows.column(0), _width(vectors))


def _unpacked(row: pa.RecordBatch, dims: int) -> tuple[pa.Array, np.ndarray, int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    cell = {n: row.column(row.schema.get_field_index(n))[0] for n in ("width", "data", "cluster", "upper", "lower")}
    width = cell["width"].as_py()
    vectors = np.frombuffer(cell["data"].as_buffer(), f"<i{width}").astype(np.int64).reshape(-1, dims)
    state = tuple(np.frombuffer(cell[n].as_buffer(), kind).copy() for n, kind in (("cluster", np.int32), ("upper", np.float64), ("lower", np.float64)))
    return row.column(row.schema.get_field_index("ids")).flatten(), vectors, width, state


def _singly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)


def _total(blocks: DataFrame, column: str) -> dict[int, int]:
    """The blocks' arrays added up, by place: as many rows as a centroid table has numbers."""
    added = blocks.select(F.posexplode(column)).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("n"))
    return {r["pos"]: int(r["n"]) for r in added.collect()}


def _moved(blocks: DataFrame, c: Centroids) -> Centroids:
    """Centroids after a round: the floors of the exact means of their vectors; one without vectors stays."""
    k, dims = c.at.shape
    counts, sums = _total(blocks, "counts"), _total(blocks, "sums")
    at = c.at.copy()
    for j in range(k):
        if counts.get(j):
            at[j] = [sums[j * dims + i] // counts[j] for i in range(dims)]
    way = np.sqrt(np.array([squared(at[j : j + 1], c.at[j])[0] for j in range(k)], np.float64))
    return Centroids(at, way * (1 + ROOM))


ASSIGNED = "vec_id long, cluster int, distance long"


def cluster_vectors(vectors: DataFrame, work: Workspace, k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> tuple[DataFrame, Centroids | None, DataFrame | None]:
    """Of ``scaled`` vectors: (``ASSIGNED`` rows, the final centroids, the last round's blocks).

    Every round assigns all vectors to their nearest centroid and moves the
    centroids; in the end vectors are assigned once more.
    """
    spark = vectors.sparkSession
    at = first_centroids(vectors, k, seed)
    if not len(at):
        return spark.createDataFrame([], ASSIGNED), None, None
    c = Centroids(at, np.zeros(len(at)))
    blocks = work.table(vectors.mapInArrow(lambda batches: _blocked(batches, c, dims), BLOCKS), "round0")
    for i in range(1, rounds + 1):
        c = _moved(blocks, c)
        blocks = work.table(blocks.select("ids", "width", "data", "cluster", "upper", "lower").mapInArrow(_next(c, dims), BLOCKS), f"round{i}")
        work.keep_only(f"round{i}")

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _singly(batches):
            ids, found, _, (cluster, _, _) = _unpacked(row, dims)
            yield pa.record_batch([ids, pa.array(cluster), pa.array(squared(found, c.at[cluster]))], names=["vec_id", "cluster", "distance"])

    return blocks.select("ids", "width", "data", "cluster", "upper", "lower").mapInArrow(assigned, ASSIGNED), c, blocks


def _next(c: Centroids, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _singly(batches):
            ids, vectors, width, state = _unpacked(row, dims)
            yield _round(vectors, state, c, ids, width)

    return run


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, c, blocks = cluster_vectors(scaled(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 64), Workspace(spark, "clusters"))
    if c is None:
        return rows.selectExpr("*", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256")
    sums = _total(blocks, "inertia")
    of = spark.createDataFrame([(j, sums[j], sum(sums.values()), centroid_digest(x)) for j, x in enumerate(c.at)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> str:
    """The same by a scan of all centroids in every round."""
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM v ORDER BY h, v LIMIT {k}))",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT r, c, d FROM (SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS rn FROM
  (SELECT r, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{i})) WHERE rn = 1)"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(n.m, c{i}.m) AS m FROM c{i} LEFT JOIN (SELECT c, list(m ORDER BY p) AS m FROM
  (SELECT c, p, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM (SELECT a.c, unnest(v.v) AS x, generate_subscripts(v.v, 1) AS p FROM v JOIN a{i} a ON v.r = a.r) GROUP BY c, p)
  GROUP BY c) n ON c{i}.c = n.c)"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v ON v.r = a.r JOIN c{rounds} ON c{rounds}.c = a.c"""
