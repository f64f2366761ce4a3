"""Exact set-similarity self-join on word shingles (operator 8).

Two documents link when the Jaccard similarity of their sets of 5-word shingles is at least
``num / den`` (3/4). Equal sets form one class. For the rest:

1. Sets are packed into hash shards once; a shard counts its shingles and answers with those
   that more than one set has. A set with too few of them has no partner.
2. Every set is ordered by global frequency, rare first; only a prefix of it is indexed. A set's
   size and a probe's position bound the sizes and positions of its partners, so the list of a
   shingle is cut into blocks by size and by position in the prefix, and a probe reads only the
   blocks inside those bounds (:func:`_probed`); the others are skipped whole, in the pivot join
   (3) too.
3. Each list's pivot is the set with the fewest rarer tokens (the original among edited copies):
   all others are compared with it first. What is linked to one pivot is one component already;
   only pairs across components remain.
4. Of those, a pair that shares a pivot is decided from the overlaps with the pivot where the
   bounds they give are enough, and by intersection otherwise.

No list is collected, and nothing is capped: joins on a frequent shingle are plain joins of two
shuffles, and lists within one component yield no pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meeple.llm.common import (
    batches_of, connected_components, give_back_memory, lean, mix64, release, shards, ship_code, stage, text_bytes_of, unstage,
    word_hashes,
)

WORDS = 5
NUM, DEN = 75, 100
_WEIGHTS = [np.uint64(w) for w in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_BATCH_CHARS = 8 << 20
_ROW = "shard int, batch long, data binary"


def shingles(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's 5-word shingles (fewer words: of the whole
    sequence; none: empty)."""
    words, offsets = word_hashes(texts)
    n = len(words)
    total = np.zeros(n, dtype=np.uint64)
    for k, w in enumerate(_WEIGHTS[:WORDS]):
        total[: max(0, n - k)] += mix64(words[k:] * w)
    total = mix64(total)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= WORDS:
            out.append(np.unique(total[a : b - WORDS + 1]))
        elif b > a:
            h = hashlib.blake2b(words[a:b].tobytes(), digest_size=8, salt=bytes([b - a])).digest()
            out.append(np.frombuffer(h, np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _pack(tokens: np.ndarray, rows: np.ndarray, n_shards: int):
    """(shard, bytes) of sorted tokens and the rows they are in: 48 low bits a token, how many
    tokens there are for each value of the 16 high bits, and 16 bits a row."""
    high = (tokens >> np.uint64(48)).astype(np.int64)
    shard = high * n_shards >> 16
    edges = np.searchsorted(shard, np.arange(n_shards + 1))
    low = np.ascontiguousarray(tokens.view(np.uint16).reshape(-1, 4)[:, :3])
    for s in np.flatnonzero(np.diff(edges)):
        a, b = edges[s], edges[s + 1]
        first = -(-(int(s) << 16) // n_shards)
        counts = np.bincount(high[a:b] - first).astype(np.uint32)
        head = np.array([b - a, len(counts), first], dtype=np.uint32)
        yield int(s), b"".join([head.tobytes(), counts.tobytes(), low[a:b].tobytes(), rows[a:b].astype(np.uint16).tobytes()])


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, k, first = (int(x) for x in np.frombuffer(data, np.uint32, 3))
    counts = np.frombuffer(data, np.uint32, k, 12)
    at = 12 + 4 * k
    words = np.zeros((n, 4), dtype=np.uint16)
    words[:, :3] = np.frombuffer(data, np.uint16, 3 * n, at).reshape(n, 3)
    words[:, 3] = np.repeat(np.arange(first, first + k), counts)
    return words.view(np.uint64).ravel(), np.frombuffer(data, np.uint16, n, at + 6 * n)


def prefix_length(n: int) -> int:
    """How many of a set's tokens, in any global order, must hold one of each partner's."""
    return n - -(-NUM * n // DEN) + 1


def sets(docs: DataFrame, id_col: str) -> DataFrame:
    """id, n (size), digest and, for sets that may have partners, ``tokens``: those shingles that
    other sets have too, by global frequency, rare first. The n - size(tokens) others precede
    them. One set at least of each digest carries its tokens."""
    spark = docs.sparkSession
    ship_code(spark)
    # a shingle a word: about twice the text's bytes
    n_shards = min(shards(spark, n_bytes=2 * text_bytes_of(docs)), 1 << 16)
    row = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), ("data", pa.binary())])

    def split(batches):
        for number, texts, rows in batches_of(batches, "text", _BATCH_CHARS):
            ids = rows.column(0)
            known = np.array(ids.is_valid().to_pylist(), dtype=np.uint8)
            found: list[np.ndarray] = []
            for a in range(0, len(texts), 256):
                found += shingles(texts[a : a + 256])
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in found]
            seen: dict[bytes, int] = {}
            first = np.array([seen.setdefault(d, i) == i for i, d in enumerate(digests)])
            sizes = np.array([len(s) for s in found], dtype=np.int64)
            meta = b"".join([
                np.array([len(texts)], np.int64).tobytes(), np.array(ids.fill_null(0), np.int64).tobytes(),
                sizes.tobytes(), known.tobytes(), first.astype(np.uint8).tobytes(), *digests,
            ])
            spread = int(mix64(np.array([number], np.uint64))[0])  # numbers are multiples of 2**32 and a few
            out = [(-1 - spread % n_shards, meta)]
            own = [i for i in np.flatnonzero(first) if sizes[i]]
            if own:
                tokens = np.concatenate([found[i] for i in own])
                at = np.repeat(np.array(own), sizes[own])
                order = np.argsort(tokens, kind="stable")
                out += _pack(tokens[order], at[order], n_shards)
            for s, data in out:
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([number], pa.int64()), pa.array([data], pa.binary())], schema=row)

    def count(key, group):
        if key[0].as_py() < 0:
            return group
        numbers = group.column("batch").to_pylist()
        parts = [_unpack(d) for d in group.column("data").to_pylist()]
        tokens = np.concatenate([t for t, _ in parts])
        order = np.argsort(tokens, kind="stable")
        ordered = tokens[order]
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        length = np.diff(np.append(edge, len(ordered)))
        counts = np.empty(len(tokens), dtype=np.uint32)
        counts[order] = np.repeat(length, length)
        data, at = [], 0
        for t, r in parts:
            c = counts[at : at + len(t)]
            at += len(t)
            keep = c > 1
            data.append(b"".join([np.array([keep.sum()], np.int64).tobytes(), t[keep].tobytes(), c[keep].tobytes(), r[keep].tobytes()]))
        give_back_memory()
        return pa.Table.from_arrays(
            [group.column("shard"), pa.array(numbers, pa.int64()), pa.array(data, pa.binary())], schema=row
        )

    # the batch limit needs the whole partition: ids first, text second
    packed = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).cast("long").alias("id"), "text").mapInArrow(lean(split), _ROW)
    answers = stage(packed.groupBy("shard").applyInArrow(count, _ROW), "shingle-counts")
    release(spark)
    out = stage(answers.groupBy("batch").applyInArrow(_gather, "id long, n long, digest binary, tokens array<long>"), "sets")
    unstage(answers)
    release(spark)
    return out


def _gather(key, group):
    """A batch's documents, with the tokens that the shards found to be shared."""
    meta, parts = None, []
    for shard, data in zip(group.column("shard").to_pylist(), group.column("data").to_pylist()):
        if shard < 0:
            meta = data
            continue
        n = int(np.frombuffer(data, np.int64, 1)[0])
        if n:
            parts.append((
                np.frombuffer(data, np.uint64, n, 8), np.frombuffer(data, np.uint32, n, 8 + 8 * n),
                np.frombuffer(data, np.uint16, n, 8 + 12 * n),
            ))
    n = int(np.frombuffer(meta, np.int64, 1)[0])
    ids, sizes = np.frombuffer(meta, np.int64, n, 8), np.frombuffer(meta, np.int64, n, 8 + 8 * n)
    known, first = np.frombuffer(meta, np.uint8, n, 8 + 16 * n), np.frombuffer(meta, np.uint8, n, 8 + 17 * n)
    digests = [meta[8 + 18 * n + 16 * i : 8 + 18 * n + 16 * (i + 1)] for i in range(n)]
    kept: list[list[int] | None] = [None] * n
    if parts:
        tokens, counts, rows = (np.concatenate([p[k] for p in parts]) for k in range(3))
        order = np.lexsort((tokens, counts, rows))
        tokens, rows = tokens[order].view(np.int64), rows[order]
        edges = np.searchsorted(rows, np.arange(n + 1))
        for i in np.flatnonzero(np.diff(edges)):
            shared = tokens[edges[i] : edges[i + 1]]
            if first[i] and sizes[i] - len(shared) < prefix_length(int(sizes[i])):
                kept[i] = shared.tolist()
    give_back_memory()
    return pa.Table.from_arrays(
        [
            pa.array(ids, pa.int64(), mask=known == 0), pa.array(sizes, pa.int64()),
            pa.array(digests, pa.binary()), pa.array(kept, pa.list_(pa.int64())),
        ],
        names=["id", "n", "digest", "tokens"],
    )


def _needed(a, b):
    """Smallest overlap of two sets of these sizes that makes a link."""
    return F.ceil((a + b) * NUM / F.lit(float(NUM + DEN)) - 1e-9)


def _links(a, b, overlap):
    return F.lit(DEN) * overlap >= F.lit(NUM) * (a + b - overlap)


def _admissible(p: str, q: str):
    """May the sets of two index entries link, from sizes and positions alone?"""
    a, b = F.col(f"{p}.n"), F.col(f"{q}.n")
    return (
        (DEN * F.least(a, b) >= NUM * F.greatest(a, b))
        & (F.least(a - F.col(f"{p}.pos"), b - F.col(f"{q}.pos")) >= _needed(a, b))
    )


def _verified(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """x, y, overlap, linked of pairs (x, y), by intersection."""
    a = own.select(F.col("cid").alias("x"), F.col("n").alias("nx"), F.col("tokens").alias("tx"))
    b = own.select(F.col("cid").alias("y"), F.col("n").alias("ny"), F.col("tokens").alias("ty"))
    both = pairs.select("x", "y").join(a, "x").join(b, "y")
    overlap = F.size(F.array_intersect("tx", "ty")).cast("long")
    return both.select("x", "y", "nx", "ny", overlap.alias("overlap")).withColumn("linked", _links(F.col("nx"), F.col("ny"), F.col("overlap")))


#: Index blocks: sizes within a factor of 4/3 share a band, and a prefix has so many blocks.
_BAND = float(np.log(DEN / NUM))
_BLOCKS = 4


def _band(size):
    return F.floor(F.log(size.cast("double")) / _BAND).cast("int")


def _indexed(entries: DataFrame) -> DataFrame:
    """Index entries with their block: the band of the size, the part of the prefix."""
    prefix = F.col("n") - F.ceil(F.col("n") * NUM / DEN) + 1
    return entries.withColumn("band", _band(F.col("n"))).withColumn("block", F.floor(_BLOCKS * F.col("pos") / prefix).cast("int"))


def _probed(entries: DataFrame, largest) -> DataFrame:
    """A row for each block that may hold partners of an entry, their sizes up to ``largest``.

    A pair needs needed = share * (n + m) tokens in common, share = NUM / (NUM + DEN). The n - pos tokens
    from the probe's position on must be as many, which bounds m; in a band, the partner's position
    is at most m - needed, in parts of its prefix (at least m * (1 - NUM / DEN) long) less than
    (1 - share - share * n / m) * DEN / (DEN - NUM), which grows with m."""
    n, share = F.col("n"), NUM / (NUM + DEN)
    reach = F.least(largest, F.floor((n - F.col("pos")) / share - n + 1e-6))
    least = F.ceil(n * NUM / DEN)
    banded = entries.withColumn("reach", reach).filter(F.col("reach") >= least).withColumn(
        "band", F.explode(F.sequence(_band(least), _band(F.col("reach"))))
    )
    most = F.least(F.col("reach"), F.ceil(F.exp((F.col("band") + 1) * _BAND)) + 1)
    last = F.floor(_BLOCKS * DEN / (DEN - NUM) * (1 - share - share * n / most) + 1e-6).cast("int")
    return banded.withColumn("last", last).filter("last >= 0").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.least(F.lit(_BLOCKS - 1), "last")))
    ).drop("reach", "last")


def _same_block():
    return (F.col("p.token") == F.col("q.token")) & (F.col("p.band") == F.col("q.band")) & (F.col("p.block") == F.col("q.block"))


def _across(probe: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs of admissible entries of one shingle and different components, the probe's set being
    the larger one (ties: the larger cid)."""
    left, right = _probed(probe, F.col("n")).alias("p"), _indexed(index).alias("q")
    return (
        left.join(right, _same_block() & (F.col("p.comp") != F.col("q.comp"))
                  & (F.struct("p.n", "p.cid") > F.struct("q.n", "q.cid")) & _admissible("p", "q"))
        .select(F.least("p.cid", "q.cid").alias("x"), F.greatest("p.cid", "q.cid").alias("y"))
    )


def _decided(pairs: DataFrame, known: DataFrame, own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """x, y, linked of ``pairs``: from overlaps with a shared pivot where the bounds decide, else by
    intersection; and the table of bounds it reads. ``known``: x (pivot), y, overlap, nx, ny.

    With pivot p: overlap(x, y) is at least overlap(p, x) + overlap(p, y) - |p| and at most
    min(overlap(p, x), overlap(p, y)) + min(|x| - overlap(p, x), |y| - overlap(p, y))."""
    def seen(name):
        return known.select(F.col("x").alias("p"), F.col("y").alias(name), F.col("nx").alias("np"), F.col("ny").alias(f"n{name}"), F.col("overlap").alias(f"o{name}"))

    rest_x, rest_y = F.col("nx") - F.col("ox"), F.col("ny") - F.col("oy")
    bounds = (
        pairs.join(seen("x"), "x").join(seen("y").drop("np"), ["p", "y"])
        .withColumn("low", F.col("ox") + F.col("oy") - F.col("np"))
        .withColumn("high", F.least("ox", "oy") + F.least(rest_x, rest_y))
        .withColumn("need", _needed(F.col("nx"), F.col("ny")))
        .groupBy("x", "y").agg(F.max(F.col("low") - F.col("need")).alias("over"), F.min(F.col("high") - F.col("need")).alias("under"))
    )
    judged = stage(pairs.join(bounds, ["x", "y"], "left"), "bounds")
    checked = _verified(judged.filter("over IS NULL OR (over < 0 AND under >= 0)"), own).select("x", "y", "linked")
    return checked.unionByName(judged.filter("over >= 0").select("x", "y", F.lit(True).alias("linked"))), judged


def components(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, n_shingles and component_id (smallest id reachable by links) of every row.

    NULL or empty texts, or texts of white space: 0 shingles, a component of their own. Repeated
    rows are equal sets. Fewer than five words: the whole sequence is the one shingle."""
    spark = docs.sparkSession
    every = sets(docs, id_col)
    classes = stage(
        every.filter("n > 0").groupBy("digest").agg(F.min("id").alias("rep"), F.max("n").alias("n"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes",
    )
    own = stage(
        every.filter("tokens IS NOT NULL").select("digest", "tokens").dropDuplicates(["digest"])
        .join(classes, "digest").select("cid", "n", "tokens"), "partners",
    )
    # index entries: the shared part of each prefix, with positions in the whole set
    before = F.col("n") - F.size("tokens")
    prefix = F.col("n") - F.ceil(F.col("n") * NUM / DEN) + 1
    entries = stage(
        own.select("cid", "n", before.alias("before"), F.posexplode(F.slice("tokens", 1, (prefix - before).cast("int"))))
        .select(F.col("col").alias("token"), "cid", "n", (F.col("before") + F.col("pos")).alias("pos")), "index",
    )
    pivots = stage(
        entries.groupBy("token").agg(F.min(F.struct("pos", "cid", "n")).alias("p"), F.count("*").alias("size"))
        .filter("size > 1").select("token", "p.*"), "pivots",
    )
    star = (
        _probed(pivots, F.floor(F.col("n") * DEN / NUM)).alias("p").join(
            _indexed(entries).alias("q"), _same_block() & (F.col("p.cid") != F.col("q.cid")) & _admissible("p", "q")
        ).select(F.col("p.cid").alias("x"), F.col("q.cid").alias("y")).distinct()
    )
    known = stage(_verified(star, own), "pivot-overlaps")
    unstage(pivots)
    release(spark)
    # what is linked to one pivot is together: every set goes to its pivot with the most links, and
    # with it to that one's (sets apart here may be linked all the same: their pairs are looked
    # at again, and all links meet in the end)
    tied = known.filter("linked").select("x", "y")
    degree = stage(tied.groupBy("x").agg(F.count("*").alias("degree")), "pivot-degrees")
    offers = tied.join(degree, "x").select(F.col("y").alias("cid"), F.struct("degree", "x").alias("to")).unionByName(
        degree.select(F.col("x").alias("cid"), F.struct("degree", "x").alias("to"))
    )
    near = stage(offers.groupBy("cid").agg(F.max("to").alias("to")).select("cid", F.col("to.x").alias("comp")), "near-pivot")
    first = near.join(near.select(F.col("cid").alias("comp"), F.col("comp").alias("next")), "comp", "left").select(
        "cid", F.coalesce("next", "comp").alias("comp")
    )
    placed = stage(entries.join(first, "cid", "left").withColumn("comp", F.coalesce("comp", "cid")), "placed")
    unstage(entries, degree, near)
    parts = placed.groupBy("token", "comp").agg(F.count("*").alias("size"))
    main = stage(
        parts.groupBy("token").agg(F.max_by("comp", F.struct("size", "comp")).alias("main"), F.count("*").alias("parts"))
        .filter("parts > 1").select("token", "main"), "main-parts",
    )
    split = stage(placed.join(main, "token"), "open-lists")
    unstage(placed, main)
    minor, major = split.filter("comp <> main"), split.filter("comp = main")
    rest = stage(
        _across(minor, split).unionByName(_across(major, minor)).distinct()
        .join(known.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")), ["x", "y"], "left_anti"), "open-pairs",
    )
    unstage(split)
    release(spark)
    decided, judged = _decided(rest, known, own)
    links = stage(decided.filter("linked").select("x", "y").unionByName(known.filter("linked").select("x", "y")), "links")
    unstage(judged, rest, known, own)
    release(spark)
    joined = connected_components(links, "x", "y")
    named = classes.select("digest", "cid", "rep").join(joined.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    named = stage(named, "named")
    smallest = stage(named.groupBy("component").agg(F.min("rep").alias("component_id")), "smallest")
    placed_in = stage(named.select("digest", "component").join(smallest, "component").select("digest", "component_id"), "class-components")
    unstage(links, joined, classes, named, smallest)
    release(spark)
    out = stage(
        every.join(placed_in, "digest", "left").select(
            F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        ), "components",
    )
    unstage(every, placed_in)
    release(spark)
    return out


def op8_jaccard(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document; odd rows as in :func:`components`. Rows
    with a NULL id are members of their component, and it is named by its smallest other id."""
    return components(docs)
