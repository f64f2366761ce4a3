"""Centroid clustering with a vantage-point tree over the centroids (operator 11).

Vectors become integers once per pass, so every distance and every sum is exact. Each round the
driver builds a vantage-point tree over the centroids (a model of k rows) and broadcasts it. A
task searches it for its vectors, best first: every vector keeps the lower bounds of the subtrees
it has not opened, opens the one of least bound and stops once that bound is above its best
distance. The pruning radius is inclusive, so a centroid at the same distance is always seen and
the smaller number wins. A task sends one row of sums for each cluster, and the new centroids are
floors of exact quotients. All vectors of a batch take a step together, in numpy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meeple.llm.common import few_files, lean, ship_code, stage

CLUSTERS = 40
ROUNDS = 5
DIMS = 64
SCALE = 256
SALT = "2:"
#: Centroids in a leaf of the tree.
LEAF = 4
#: Vectors whose search takes its steps together.
SEARCH_ROWS = 4096
#: Integer vectors must be shorter than 2**30, so that a squared distance fits a long.
MAX_SQUARED_LENGTH = 2.0**60
#: Relative slack of the float bounds: far above their rounding, so that a prune is never wrong.
_SLACK = 1e-9


def integer_rows(batch: pa.RecordBatch, dims: int | None, scale: int, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors of a batch (``embedding``) and their components
    floor(scale * x), x as double, as integral float64. Usable: not NULL, ``dims`` components (any
    one length of the batch if None is not asked for here), all present and finite, and a squared
    integer length below ``longest``."""
    column = batch.column(batch.schema.get_field_index("embedding"))
    sizes = np.asarray(column.value_lengths().fill_null(-1))
    at = np.flatnonzero(sizes == dims)
    flat = column.take(pa.array(at)).flatten()
    x = np.array(flat.cast(pa.float64()).fill_null(np.nan), dtype=np.float64).reshape(len(at), dims)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(scale * x)
        good = (x * x).sum(axis=1) < longest  # false for NaN too
    return at[good], x[good]


@dataclass
class VantageTree:
    """Nodes in order of construction. An inner node has a vantage centroid, two subtrees and the
    least and greatest distance from the vantage point to the centroids of each; a leaf has up to
    ``LEAF`` centroids, in ascending order."""

    centroids: np.ndarray  # k x dims, int64
    members: list[np.ndarray]  # an inner node: its vantage centroid
    children: list[tuple[int, int] | None]
    shells: list[tuple[tuple[float, float], tuple[float, float]] | None]

    @classmethod
    def build(cls, centroids: np.ndarray) -> VantageTree:
        tree = cls(centroids, [], [], [])
        if len(centroids):
            tree._grow(np.arange(len(centroids)))
        return tree

    def _grow(self, numbers: np.ndarray) -> int:
        here = len(self.members)
        self.members.append(numbers)
        self.children.append(None)
        self.shells.append(None)
        if len(numbers) > LEAF:
            vantage, rest = numbers[:1], numbers[1:]
            away = squared(self.centroids[rest], self.centroids[vantage])[:, 0]
            order = np.argsort(away, kind="stable")
            halves = np.array_split(order, 2)
            root = np.sqrt(away.astype(np.float64))
            self.members[here] = vantage
            self.shells[here] = tuple((root[h].min(), root[h].max()) for h in halves)
            self.children[here] = tuple(self._grow(np.sort(rest[h])) for h in halves)
        return here

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each point (ties: the smallest) and the squared distance."""
        number = np.full(len(points), -1, dtype=np.int64)
        best = np.full(len(points), np.iinfo(np.int64).max, dtype=np.int64)
        radius = np.full(len(points), np.inf)
        bounds = np.full((len(points), len(self.members)), np.inf)
        bounds[:, 0] = 0.0
        active = np.arange(len(points))
        while len(active):
            node = bounds[active].argmin(axis=1)
            bound = bounds[active, node]
            going = (bound < np.inf) & (bound <= radius[active])  # inclusive: ties are looked at
            active, node, bound = active[going], node[going], bound[going]
            bounds[active, node] = np.inf
            for opened in np.unique(node):
                of = node == opened
                self._open(opened, active[of], bound[of], points, number, best, radius, bounds)
        return number, best

    def _open(self, node, rows, bound, points, number, best, radius, bounds) -> None:
        members = self.members[node]
        away = squared(points[rows], self.centroids[members])
        nearest = away.argmin(axis=1)  # the first of equals: the smallest number
        least, which = away[np.arange(len(rows)), nearest], members[nearest]
        better = (least < best[rows]) | ((least == best[rows]) & (which < number[rows]))
        won = rows[better]
        best[won], number[won] = least[better], which[better]
        radius[won] = np.sqrt(least[better].astype(np.float64)) * (1 + _SLACK)
        if self.children[node] is None:
            return
        d = np.sqrt(away[:, 0].astype(np.float64))
        for child, (lo, hi) in zip(self.children[node], self.shells[node]):
            apart = np.maximum(lo - d, d - hi) - _SLACK * (d + hi)
            bounds[rows, child] = np.maximum(bound, apart)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances (len(a) x len(b)) of int64 rows."""
    out = np.empty((len(a), len(b)), dtype=np.int64)
    for j in range(len(b)):
        diff = a - b[j]
        out[:, j] = np.einsum("ij,ij->i", diff, diff)
    return out


def _assigned(batches, tree: VantageTree, dims: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, integer vectors, cluster, squared distance) of the usable rows, a few at a time."""
    for batch in batches:
        at, x = integer_rows(batch, dims, scale, MAX_SQUARED_LENGTH)
        ids = batch.column(0).take(pa.array(at))
        for a in range(0, len(at), SEARCH_ROWS):
            points = x[a : a + SEARCH_ROWS].astype(np.int64)
            yield ids.slice(a, SEARCH_ROWS), points, *tree.nearest(points)


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, dims: int = DIMS, scale: int = SCALE, salt: str = SALT) -> np.ndarray:
    """The usable vectors with the least SHA-256 of ``salt`` and id, as integers (NULL ids last;
    repeated ids by their components)."""
    ship_code(vectors.sparkSession)

    def usable(batches):
        for batch in batches:
            at, x = integer_rows(batch, dims, scale, MAX_SQUARED_LENGTH)
            rows = pa.ListArray.from_arrays(
                pa.array(np.arange(0, len(at) * dims + 1, dims, dtype=np.int32)), pa.array(x.astype(np.int64).ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), rows], names=["vec_id", "parts"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = vectors.select("vec_id", "embedding").mapInArrow(lean(usable), f"vec_id {kind}, parts array<long>")
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = rows.orderBy(digest.asc_nulls_last(), "parts").limit(k).collect()
    return np.array([r["parts"] for r in first], dtype=np.int64).reshape(len(first), dims)


def next_centroids(vectors: DataFrame, centroids: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """One round: every vector to its nearest centroid, every non-empty cluster's exact floor mean.

    A task sends its clusters' counts and sums (at most k rows); the driver gets k * (dims + 1)
    numbers, the model itself."""
    k, dims = centroids.shape
    sent = vectors.sparkSession.sparkContext.broadcast(VantageTree.build(centroids))

    def sums(batches):
        total = np.zeros((k, dims + 1), dtype=np.int64)  # the count, then the sums
        for _, points, cluster, _ in _assigned(batches, sent.value, dims, scale):
            for c in np.unique(cluster):
                own = points[cluster == c]
                total[c, 0] += len(own)
                total[c, 1:] += own.sum(axis=0)
        full = np.flatnonzero(total[:, 0])
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(0, len(full) * (dims + 1) + 1, dims + 1, dtype=np.int32)), pa.array(total[full].ravel())
        )
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), lists], names=["cluster", "sums"])

    found = (
        vectors.select("vec_id", "embedding").mapInArrow(lean(sums), "cluster int, sums array<long>")
        .select("cluster", F.posexplode("sums").alias("place", "part"))
        .groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    )
    totals: dict[int, dict[int, int]] = {}
    for r in found.collect():
        totals.setdefault(r["cluster"], {})[r["place"]] = int(r["total"])
    out = centroids.copy()
    for c, parts in totals.items():
        out[c] = [parts[j + 1] // parts[0] for j in range(dims)]
    return out


def cluster(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, salt: str = SALT
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable vector.

    Not usable, and not in the result: NULL vectors, other lengths than ``dims``, NULL or
    non-finite components, and integer vectors of 2**30 or longer, whose distances would not fit a
    long. Repeated rows are vectors like others. With fewer than ``k`` usable vectors there
    are as many centroids; with none, no rows. An inertia beyond a long is NULL. Other columns are
    not read."""
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(vectors, k, dims, scale, salt)
    if not len(centroids):
        return spark.createDataFrame(
            [], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    for _ in range(rounds):
        centroids = next_centroids(vectors, centroids, scale)
    sent = spark.sparkContext.broadcast(VantageTree.build(centroids))

    def assign(batches):
        for ids, _, number, distance in _assigned(batches, sent.value, dims, scale):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(number.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    assigned = stage(
        vectors.select("vec_id", "embedding").mapInArrow(lean(assign), f"vec_id {kind}, cluster int, distance long"), "assigned"
    )
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    of = {r["cluster"]: int(r["total"]) for r in sums}
    fits = lambda n: n if n < 2**63 else None
    report = [
        (c, fits(n), fits(sum(of.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c, n in sorted(of.items())
    ]
    clusters = spark.createDataFrame(report, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return few_files(assigned).join(F.broadcast(clusters), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op11_clusters(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector;
    odd rows as in :func:`cluster`."""
    return cluster(vectors)


def _sql() -> str:
    """The same rounds as unrolled table expressions."""
    distance = "list_sum(list_transform(list_zip(v.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

    def assigned(i: int) -> str:
        nearest = f"min({{'distance': CAST({distance} AS BIGINT), 'cluster': c.cluster}})"
        every = f"SELECT v.vec_id, v.rid, v.p, {nearest} AS r FROM kept v, c{i} c GROUP BY v.vec_id, v.rid, v.p"
        return f"SELECT vec_id, rid, p, r.cluster AS cluster, r.distance AS distance FROM ({every})"

    steps = []
    for i in range(ROUNDS):
        steps.append(f"a{i} AS MATERIALIZED ({assigned(i)})")
        steps.append(
            f"s{i} AS (SELECT cluster, place, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(p) AS x, "
            f"generate_subscripts(p, 1) AS place FROM a{i}) GROUP BY ALL)"
        )
        floor = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
        steps.append(f"m{i} AS (SELECT cluster, list({floor} ORDER BY place) AS p FROM s{i} GROUP BY cluster)")
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.p, c.p) AS p FROM c{i} c LEFT JOIN m{i} m USING (cluster))")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, p) - 1 AS INTEGER) AS cluster, p
  FROM (SELECT sha256('{SALT}' || CAST(vec_id AS VARCHAR)) AS h, p FROM kept ORDER BY h, p LIMIT {CLUSTERS})
), {', '.join(steps)}, a AS MATERIALIZED ({assigned(ROUNDS)})
SELECT vec_id, a.cluster, distance, CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM a JOIN c{ROUNDS} c ON a.cluster = c.cluster
"""


ORACLE_SQL = _sql()
