"""Hard-negative mining with residue-number-system matrix products (operator 12).

Vectors become integers; a score is an exact integer inner product. Matrices are reduced modulo
small primes, multiplied in float32 (every partial sum stays an exact integer below 2**24), and
the signed scores are put together from the residues by Chinese remaindering. As many primes are
used as the lengths of the vectors of a block ask for (Cauchy-Schwarz).

Anchors (rows with an id divisible by ``ANCHOR_EVERY``) meet all rows in tiles of at most about
``BLOCK`` anchors by ``BLOCK`` rows, dealt by a row number, so neither a hot label nor a repeated id makes
a tile large. A first pass over the tiles gives every anchor its best rows of the same label, a
second one the best rows of other labels in the score window of each positive. Tiles keep a
few rows for each anchor, and these are merged by rank.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meeple.llm.common import few_files, lean, release, ship_code, stage, unstage

SCALE = 256
ANCHOR_EVERY = 100
#: Labels 0 to 9; every ``SHIFT_EVERY``-th id gets the next one.
LABELS = 10
SHIFT_EVERY = 7
POSITIVES = 5
NEGATIVES = 5
#: A negative scores from 80 to 100 hundredths of the positive's score.
LOW, HIGH = 80, 100
#: Rows, and anchors, of a tile.
BLOCK = 32_768
#: Scores held at once.
SCORES = 1 << 21
#: Integer vectors must be shorter than 2**31, so that a score fits a long.
MAX_SQUARED_LENGTH = 2.0**62
#: Exact integers of a float32.
_EXACT = 1 << 24
_LARGEST_MODULUS = 1021


# --- residue arithmetic -----------------------------------------------------------------------


@lru_cache(maxsize=1)
def moduli() -> list[int]:
    """Odd primes from ``_LARGEST_MODULUS`` down."""
    return [n for n in range(_LARGEST_MODULUS, 2, -2) if all(n % d for d in range(3, math.isqrt(n) + 1, 2))]


def moduli_for(bound: float) -> list[int]:
    """The fewest primes whose product is above four times ``bound``, the largest absolute score."""
    product, n = 1, 0
    while product <= 4 * bound + 4:
        product *= moduli()[n]
        n += 1
    return moduli()[:n]


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p about zero, for integral float32 below 2**24: quotient, product and difference
    are exact, so the result is congruent (at most one off the shortest one at a half)."""
    return x - np.float32(p) * np.rint(x * np.float32(1 / p))


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Integral float64 components modulo p, about zero, as float32 (fmod is exact)."""
    r = np.fmod(x, p)
    return (r - p * np.rint(r / p)).astype(np.float32)


def product_modulo(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p of float32 residues, in runs of components whose sums are exact."""
    run = (_EXACT - p) // ((p + 1) // 2) ** 2
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    for c in range(0, a.shape[1], run):
        out = _centred(out + a[:, c : c + run] @ b[:, c : c + run].T, p)
    return out


def reconstruct(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed int64 numbers with these residues: mixed-radix digits about zero (in float32, all
    exact), then their weighted sum. Weights are taken modulo 2**64, as the sum is."""
    digits: list[np.ndarray] = []
    out, weight = np.zeros(parts[0].shape, dtype=np.int64), 1
    for i, p in enumerate(primes):
        digit = parts[i]
        for earlier, q in zip(digits, primes):
            inverse = pow(q, -1, p)
            inverse -= p * (inverse > p // 2)
            digit = _centred(_centred(digit - earlier, p) * np.float32(inverse), p)
        digits.append(digit)
        out += digit.astype(np.int64) * np.int64((weight + 2**63) % 2**64 - 2**63)
        weight *= p
    return out


class ResidueRows:
    """Rows of integral float64 components with their residues, computed once for each prime."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.length = math.sqrt((x * x).sum(axis=1).max()) if x.size else 0.0
        self._parts: dict[int, np.ndarray] = {}

    def modulo(self, p: int) -> np.ndarray:
        if p not in self._parts:
            self._parts[p] = residues(self.x, p)
        return self._parts[p]


def scores(a: ResidueRows, b: ResidueRows, lo: int, hi: int) -> np.ndarray:
    """Exact inner products of rows ``lo`` to ``hi`` of ``a`` with all rows of ``b``."""
    primes = moduli_for(a.length * b.length * 1.000001)
    return reconstruct([product_modulo(a.modulo(p)[lo:hi], b.modulo(p), p) for p in primes], primes)


# --- a tile -----------------------------------------------------------------------------------


class _Side:
    """One side of a tile: rows in order of id (NULL last), by length of their vectors."""

    def __init__(self, table: pa.Table):
        ids = table.column("vec_id").combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        missing = np.asarray(ids.is_null())
        order = np.lexsort((np.asarray(ids.fill_null(0)), missing))
        table = table.take(pa.array(order))
        self.table, self.missing = table, missing[order]
        self.ids = np.asarray(ids.fill_null(0))[order]
        self.labels = np.asarray(table.column("label"))
        parts = table.column("parts").combine_chunks()
        parts = parts.chunk(0) if isinstance(parts, pa.ChunkedArray) else parts
        self.sizes = np.asarray(parts.value_lengths())
        self.flat, self.starts = np.asarray(parts.flatten()), np.concatenate([[0], np.cumsum(self.sizes)])

    def rows(self, at: np.ndarray) -> ResidueRows:
        size = int(self.sizes[at[0]]) if len(at) else 0
        return ResidueRows(self.flat[self.starts[at][:, None] + np.arange(size)].astype(np.float64))


def _steps(n_left: int, n_right: int):
    step = max(1, SCORES // max(1, n_right))
    return [(a, min(n_left, a + step)) for a in range(0, n_left, step)]


def _best_of_label(anchors: _Side, rows: _Side, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor place, row place, score): each anchor's ``keep`` best other rows of its label."""
    out = [(np.zeros(0, np.int64),) * 3]
    kinds = np.stack([anchors.labels, anchors.sizes], axis=1)
    order = np.lexsort((rows.sizes, rows.labels))
    sorted_labels, sorted_sizes = rows.labels[order], rows.sizes[order]
    for label, size in np.unique(kinds, axis=0):
        left = np.flatnonzero((kinds == (label, size)).all(axis=1))
        a, b = np.searchsorted(sorted_labels, [label, label + 1]) if label < np.iinfo(np.int64).max else (np.searchsorted(sorted_labels, label), len(order))
        c, d = np.searchsorted(sorted_sizes[a:b], [size, size + 1])
        right = np.sort(order[a + c : a + d])  # by id again
        if not len(right):
            continue
        lefts, rights = anchors.rows(left), rows.rows(right)
        for lo, hi in _steps(len(left), len(right)):
            s = scores(lefts, rights, lo, hi)
            other = (anchors.ids[left[lo:hi], None] != rows.ids[None, right]) | rows.missing[None, right]
            if len(right) > keep:
                hidden = np.where(other, s, np.iinfo(np.int64).min)
                least = np.partition(hidden, len(right) - keep, axis=1)[:, len(right) - keep]
                other &= s >= least[:, None]
            i, j, rank = _ranked(s, other)
            got = rank < keep
            out.append((left[lo + i[got]], right[j[got]], s[i[got], j[got]]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _ranked(s: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the masked scores, by row, then score downwards, then column; and their rank in
    the row, from 0."""
    i, j = np.nonzero(mask)
    order = np.lexsort((j, ~s[i, j], i))  # ~x falls as x grows, without overflow
    i, j = i[order], j[order]
    return i, j, np.arange(len(i)) - np.searchsorted(i, i)


def _windows(anchors: _Side, rows: _Side, positives: list[list[int]], keep: int) -> tuple[np.ndarray, ...]:
    """(anchor place, number of the positive, row place, score): for each positive score of an
    anchor, the ``keep`` best rows of other labels in its window."""
    out: list[tuple[int, int, int, int]] = []
    floor = [[-(-LOW * p // HIGH) for p in own] for own in positives]
    least = np.array([min(own, default=0) for own in floor], dtype=np.int64)
    most = np.array([max(own, default=-1) for own in positives], dtype=np.int64)
    for size in np.unique(anchors.sizes):
        left, right = np.flatnonzero(anchors.sizes == size), np.flatnonzero(rows.sizes == size)
        if not len(right):
            continue
        lefts, rights = anchors.rows(left), rows.rows(right)
        for lo, hi in _steps(len(left), len(right)):
            own = left[lo:hi]
            s = scores(lefts, rights, lo, hi)
            mask = (s >= least[own, None]) & (s <= most[own, None])
            mask &= anchors.labels[own, None] != rows.labels[None, right]
            i, j, _ = _ranked(s, mask)
            found, ends = s[i, j], np.searchsorted(i, np.arange(len(own) + 1))
            for x, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                if a == b:
                    continue
                falling = ~found[a:b]
                for k, (high, low) in enumerate(zip(positives[own[x]], floor[own[x]])):
                    start = a + int(np.searchsorted(falling, ~high))
                    for y in range(start, min(b, start + keep)):
                        if found[y] < low:
                            break
                        out.append((int(own[x]), k, int(right[j[y]]), int(found[y])))
    table = np.array(out, dtype=np.int64).reshape(-1, 4)
    return tuple(table.T)


# --- the jobs ---------------------------------------------------------------------------------


def _usable(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label (shifted), parts (integer components) of the rows that take part."""
    ship_code(vectors.sparkSession)

    def integers(batches):
        for batch in batches:
            column = batch.column(2)
            keep, lists = [], []
            sizes = np.asarray(column.value_lengths().fill_null(-1))
            starts = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])
            x = np.array(column.flatten().cast(pa.float64()).fill_null(np.nan), dtype=np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(scale * x)
                total = np.concatenate([x * x, [0.0]])
                square = np.add.reduceat(total, np.minimum(starts[:-1], len(total) - 1)) if len(sizes) else np.zeros(0)
            square = np.where(sizes > 0, square, 0.0)
            keep = np.flatnonzero((sizes >= 0) & (square < MAX_SQUARED_LENGTH))
            inside = np.repeat((sizes >= 0) & (square < MAX_SQUARED_LENGTH), np.maximum(sizes, 0))
            ends = np.concatenate([[0], np.cumsum(sizes[keep])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(x[inside].astype(np.int64)))
            place = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(place), batch.column(1).take(place), lists], names=["vec_id", "label", "parts"])

    label, vec_id = F.col("label").cast("long"), F.col("vec_id").cast("long")
    shifted = F.when(vec_id % SHIFT_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    rows = vectors.select(vec_id.alias("vec_id"), shifted.alias("label"), "embedding").filter("label IS NOT NULL AND embedding IS NOT NULL")
    return rows.mapInArrow(lean(integers), "vec_id long, label long, parts array<long>")


def _tiles(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, block: int):
    """Both sides dealt into tiles (i, j): rows into blocks i by their number, and to every block j
    of anchors; anchors the other way round."""
    left, right = max(1, math.ceil(n_anchors / block)), max(1, math.ceil(n_rows / block))
    own = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return (
        anchors.withColumn("j", own("anchor", left)).withColumn("i", every(right)).groupBy("i", "j"),
        rows.withColumn("i", own("row", right)).withColumn("j", every(left)).groupBy("i", "j"),
    )


def hard_negatives(
    vectors: DataFrame, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
    anchor_every: int = ANCHOR_EVERY, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a NULL label or vector, or a NULL or non-finite component, take no part; nor do
    vectors whose integers are 2**31 or longer, since their scores need not fit a long. Only
    vectors of one length are compared. A row with a NULL id is no anchor, its label stays, and it
    comes last among equal scores. Rows with the anchor's id are not "other rows". A repeated
    row is a candidate as often as it occurs, a repeated anchor one anchor. No rows, no anchors or
    no positives: no rows. Other columns are not read."""
    spark = vectors.sparkSession
    rows = stage(_usable(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "integer-rows")
    anchors = stage(
        rows.filter(F.col("vec_id") % anchor_every == 0).groupBy("vec_id", "label", "parts").agg(F.min("row").alias("anchor")), "anchors"
    )
    n_rows, n_anchors = rows.count(), anchors.count()

    def nearest(left, right):
        a, b = _Side(left), _Side(right)
        i, j, s = _best_of_label(a, b, positives)
        return pa.table({"anchor": a.table.column("anchor").take(pa.array(i)), "positive_id": b.table.column("vec_id").take(pa.array(j)), "positive_score": pa.array(s)})

    lefts, rights = _tiles(anchors, rows, n_anchors, n_rows, block)
    found = lefts.cogroup(rights).applyInArrow(nearest, "anchor long, positive_id long, positive_score long")
    by_score = lambda score, vec_id: [F.col(score).desc(), F.col(vec_id).asc_nulls_last()]
    best = Window.partitionBy("anchor").orderBy(*by_score("positive_score", "positive_id"))
    chosen = stage(found.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= positives), "positives")
    wanted = chosen.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("k", "positive_score", "positive_id"))).alias("wanted"))
    queries = stage(anchors.join(wanted, "anchor"), "anchors-with-positives")

    def mine(left, right):
        a, b = _Side(left), _Side(right)
        asked = a.table.column("wanted").to_pylist()
        i, k, j, s = _windows(a, b, [[p["positive_score"] for p in own] for own in asked], negatives)
        take = lambda name: [asked[x][y][name] for x, y in zip(i.tolist(), k.tolist())]
        return pa.table({
            "anchor": a.table.column("anchor").take(pa.array(i)), "k": pa.array(k.astype(np.int32)),
            "anchor_id": a.table.column("vec_id").take(pa.array(i)), "positive_id": pa.array(take("positive_id"), pa.int64()),
            "negative_id": b.table.column("vec_id").take(pa.array(j)),
            "positive_score": pa.array(take("positive_score"), pa.int64()), "negative_score": pa.array(s),
        })

    lefts, rights = _tiles(queries, rows, n_anchors, n_rows, block)
    mined = lefts.cogroup(rights).applyInArrow(
        mine, "anchor long, k int, anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    )
    order = Window.partitionBy("anchor", "k").orderBy(*by_score("negative_score", "negative_id"))
    out = stage(
        mined.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "hard-negatives",
    )
    unstage(rows, anchors, chosen, queries)
    release(spark)
    return few_files(out)


def op12_negatives(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; odd rows as in
    :func:`hard_negatives`."""
    return hard_negatives(vectors)


ORACLE_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS rid,
    CASE WHEN vec_id % {SHIFT_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), anchors AS (
  SELECT vec_id, label, p, min(rid) AS anchor FROM kept WHERE vec_id % {ANCHOR_EVERY} = 0 GROUP BY ALL
), scored AS MATERIALIZED (
  SELECT a.anchor, a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
    CAST(list_sum(list_transform(list_zip(a.p, b.p), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM anchors a, kept b WHERE len(a.p) = len(b.p)
), positives AS MATERIALIZED (
  SELECT anchor, anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) AS k
  FROM scored WHERE label = anchor_label AND vec_id IS DISTINCT FROM anchor_id QUALIFY k <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor = p.anchor AND s.label <> p.anchor_label
  AND {LOW} * p.positive_score <= {HIGH} * s.score AND {HIGH} * s.score <= {HIGH} * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""
