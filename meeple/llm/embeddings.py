"""Near-duplicate vectors by sorted projection passes (operator 10).

Equal vectors form one class first. In every pass a vector's key is a sequence of random
hyperplane signs, drawn around the mean direction of its label; the classes of a label are ordered
by it and each is compared, by cosine in double precision of the vectors themselves, with the next
``WINDOW`` ones. Passes are independent, so they are one job:
a range shuffle over (pass, label, key), with the rows at partition edges compared in a second,
small step (over as many short partitions as a window reaches). Links of all passes are united, and
the links within a component are then counted by blocked matrix products, so that a group larger than the window is counted whole.

The number of passes follows each label's size and spread (:func:`passes_for`): two vectors at
the threshold miss each other in all passes with probability ``MISS``, if signs halve the vectors.
The nearer vectors are to the label's mean, the wider is the angle at which the mean sees such a
pair, and the more passes it takes. Where vectors crowd signs do not halve them, so every pass also
measures how many signs a pair must share to be within the window. A row whose measured chance to
miss such a pair is above ``CROWDED`` is compared with all vectors of its label, by blocked
products: exact, and quadratic in a crowd. A label that would take more than ``PASSES`` passes is
compared so from the start, if that sends its rows to fewer places than the passes would.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meeple.llm.common import connected_components, few_files, lean, release, ship_code, stage, unstage

THRESHOLD = 0.93
WINDOW = 32
BITS = 48
MISS = 0.001
CROWDED = 0.01
#: Members of one block of a component when its links are counted.
BLOCK = 512
#: Vectors of one block when a crowd is compared with its label.
CROWD_BLOCK = 4096
#: Passes that a label takes at least before an exact comparison is weighed against them.
PASSES = 256
#: Labels whose sums a task holds at a time.
_SUMS = 4096
#: Components of unit vectors are summed as whole numbers of this part of one, in any order alike.
_PARTS = 1 << 24
#: Signs asked for where the neighbours are beyond the partition: no chance is counted there.
_UNKNOWN = 1000


def passes_for(n: int, threshold: float = THRESHOLD, window: int = WINDOW, spread: float = 1.0) -> int:
    """Passes after which a pair at the threshold has shared a window with probability
    1 - MISS; 0 if none can be counted on. With n vectors, those that agree on
    :func:`_usual_signs` signs are fewer than a window; each sign agrees with the chance of
    :func:`_agreement`. ``spread``: mean squared distance from the label's mean direction."""
    hit = float(_agreement(np.array(spread), threshold)) ** _usual_signs(n, window)
    return max(4, math.ceil(math.log(MISS) / math.log1p(-hit))) if hit > 1e-9 else 0


def _agreement(spread: np.ndarray, threshold: float) -> np.ndarray:
    """Chance that a random plane through the mean has a vector and a partner at the threshold on one
    side, from the vector's squared distance to the mean. The partner is taken to be as far; if it is
    farther the chance is higher, and if it is nearer this holds for the partner instead."""
    cosine = 1 - (1 - threshold) / np.maximum(spread, 1e-12)
    return 1 - np.arccos(np.clip(cosine, -1, 1)) / math.pi


def _log_miss(agree: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Logarithm of the chance to miss a partner in a pass that asks for so many equal signs."""
    return np.log1p(-np.minimum(np.power(agree, signs), 1 - 1e-12))


def _signs_needed(group: np.ndarray, key: np.ndarray, window: int, a: int, b: int) -> np.ndarray:
    """For rows a to b in order, the first signs that another vector must share to be within the
    window for sure: one more than are shared with the rows ``window`` places before and behind."""
    at = np.arange(a, b)
    needed = np.zeros(b - a, dtype=np.int64)
    for other, edge in ((at - window, 0), (at + window, len(key) - 1)):
        inside = (other >= 0) & (other < len(key))
        end = np.where(inside, other, edge)
        same = (group[at] == group[end]).all(axis=1)
        shared = BITS - np.frexp((key[at] ^ key[end]).astype(np.float64))[1]
        needed = np.maximum(needed, np.where(same, np.where(inside, shared + 1, _UNKNOWN), 0))
    return needed


def _usual_signs(n: int, window: int) -> int:
    """Signs that a pass asks for where vectors do not crowd, rounded up."""
    return math.floor(math.log2(max(2.0, 2 * n / window))) + 2


def _unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    scale = np.abs(v).max(axis=1, keepdims=True)  # large components must not overflow
    v = v / np.where(scale > 0, scale, 1)
    return v / np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-300)


def _keys(vectors: np.ndarray, passes: int) -> np.ndarray:
    """(rows x passes) keys of the first passes."""
    return np.stack([_key(vectors, t) for t in range(passes)], axis=1)


def _key(vectors: np.ndarray, t: int) -> np.ndarray:
    """A pass's keys: BITS signs of random projections, the first one highest."""
    planes = np.random.default_rng([17, t]).normal(size=(vectors.shape[1], BITS))
    return (vectors @ planes > 0) @ (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _window_pairs(group: np.ndarray, unit: np.ndarray, window: int, threshold: float, split: int | None = None):
    """Index pairs at most ``window`` apart in the same group with cosine >= threshold; with
    ``split``, only pairs from before it to behind it."""
    found = []
    for s in range(1, min(window, len(group) - 1) + 1):
        same = (group[:-s] == group[s:]).all(axis=1)
        if split is not None:
            i = np.arange(len(group) - s)
            same &= (i < split) & (i + s >= split)
        at = np.flatnonzero(same)
        if len(at):
            at = at[np.einsum("ij,ij->i", unit[at], unit[at + s]) >= threshold]
            found.append(np.stack([at, at + s], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


class _Union:
    """Union-find over the ids seen by one task; emits each id's root once."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, a: int) -> int:
        root = a
        while self.parent.setdefault(root, root) != root:
            root = self.parent[root]
        while self.parent[a] != root:
            self.parent[a], a = root, self.parent[a]
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self) -> tuple[list[int], list[int]]:
        nodes = [a for a in self.parent if self.find(a) != a]
        return [self.find(a) for a in nodes], nodes


def usable():
    """May a row link: label, vector and all components present and finite, not all zero?"""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("label").isNotNull() & fine & F.exists(e, lambda x: x != 0), F.lit(False))


def _label_plans(classes: DataFrame, threshold: float, window: int) -> DataFrame:
    """place, dim, passes, usual, centre of every label and length: how often it is sorted, the signs
    that a pass asks for where vectors do not crowd, and the mean of its unit vectors. A label no
    longer than the window needs neither planes nor a mean; passes 0: it is compared exactly."""
    ship_code(classes.sparkSession)

    def sums(batches):
        held: dict[tuple[int, int], list] = {}

        def rows():
            keys = list(held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([held[k][0] for k in keys], pa.int64()), pa.array([held[k][1] for k in keys], pa.list_(pa.int64())),
                ],
                names=["place", "dim", "n", "sums"],
            )
            held.clear()

        for batch in batches:
            dims, place = np.diff(batch.column("embedding").offsets.to_numpy()), np.array(batch.column("place"))
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                parts = np.rint(_unit(_matrix(batch.column("embedding").take(pa.array(own)))) * _PARTS).astype(np.int64)
                places, at = np.unique(place[own], return_inverse=True)
                total = np.zeros((len(places), dim), np.int64)
                np.add.at(total, at, parts)
                for p, n, row in zip(places.tolist(), np.bincount(at).tolist(), total):
                    old = held.get((p, dim))
                    held[p, dim] = [n, row] if old is None else [old[0] + n, old[1] + row]
            if len(held) >= _SUMS:
                yield from rows()
        if held:
            yield from rows()

    partial = stage(classes.select("place", "embedding").mapInArrow(lean(sums), "place long, dim int, n long, sums array<long>"), "label-sums", as_is=True)
    sizes = partial.groupBy("place", "dim").agg(F.sum("n").alias("n"))
    means = (
        partial.select("place", "dim", F.posexplode("sums").alias("i", "x")).groupBy("place", "dim", "i").agg(F.sum("x").alias("x"))
        .groupBy("place", "dim").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda c: c["x"]).alias("sums"))
    )

    def plan(batches):
        for batch in batches:
            passes, usual, centres = [], [], []
            for n, total in zip(batch.column("n").to_pylist(), batch.column("sums").to_pylist()):
                if n <= window:
                    passes.append(2)
                    usual.append(0)
                    centres.append(None)
                    continue
                centre = np.array(total, np.float64) / _PARTS / n
                wanted = passes_for(n, threshold, window, 1 - float(centre @ centre))
                passes.append(wanted if wanted <= max(PASSES, n / CROWD_BLOCK) else 0)
                usual.append(_usual_signs(n, window))
                centres.append(centre)
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("dim"), pa.array(passes, pa.int32()), pa.array(usual, pa.int32()), pa.array(centres, pa.list_(pa.float32()))],
                names=["place", "dim", "passes", "usual", "centre"],
            )

    plans = stage(sizes.join(means, ["place", "dim"]).mapInArrow(lean(plan), "place long, dim int, passes int, usual int, centre array<float>"), "label-plans")
    unstage(partial)
    return plans


def _edges(classes: DataFrame, passes: int, window: int, threshold: float, usual: int = BITS) -> DataFrame:
    """(a, b) links between classes of all passes; a spanning set of them for each task. With b NULL:
    by how much a pass that asked a for more than the usual signs raised its chance to miss a partner
    (``lost``), and that chance if no pass did (``base``), as logarithms.

    ``passes`` and ``usual`` hold for classes that have no such columns; without a ``centre`` signs
    are those of the vectors themselves."""
    spark = classes.sparkSession
    ship_code(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, value in (("passes", F.lit(passes)), ("usual", F.lit(usual)), ("centre", F.lit(None).cast("array<float>"))):
        classes = classes if name in classes.columns else classes.withColumn(name, value)

    def around(part: pa.RecordBatch) -> np.ndarray:
        unit, centre = _unit(_matrix(part.column("embedding"))), part.column("centre")
        has = np.flatnonzero(np.array(centre.is_valid()))
        if len(has):
            unit[has] -= _matrix(centre.take(pa.array(has)))
        return unit

    def project(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = np.diff(batch.column("embedding").offsets.to_numpy())
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                seen_from, times = around(part), np.array(part.column("passes"))
                agree = _agreement((seen_from * seen_from).sum(axis=1), threshold)
                for t in range(times.max()):
                    at = np.flatnonzero(times > t)
                    some = part.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), t, np.int32)), some.column("place"), pa.array(np.full(len(at), dim, np.int32)),
                            pa.array(_key(seen_from[at], t)), some.column("cid"), some.column("embedding"),
                            some.column("passes"), some.column("usual"), pa.array(agree[at]),
                        ],
                        names=["pass", "place", "dim", "key", "cid", "embedding", "passes", "usual", "agree"],
                    )

    kind = classes.schema["embedding"].dataType.simpleString()
    keyed = classes.select(F.col("place").cast("long").alias("place"), "cid", "embedding", "passes", "usual", "centre").mapInArrow(
        lean(project), f"pass int, place long, dim int, key long, cid long, embedding {kind}, passes int, usual int, agree double"
    )
    order = ["pass", "place", "dim", "key", "cid"]
    ordered = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    out_schema = f"part int, head boolean, pos int, pass int, place long, dim int, a long, b long, lost double, base double, embedding {kind}"

    def compare(batches):
        part, united, held, first, seen, done = TaskContext.get().partitionId(), _Union(), None, [], 0, 0

        def crowd(table, end):
            group = np.stack([np.array(table.column(c)) for c in ("pass", "place", "dim")], axis=1)
            base = seen - table.num_rows
            rows = table.slice(done - base, end - done)
            needed = _signs_needed(group, np.array(table.column("key")), window, done - base, end - base)
            number, passes, usual, agree = (np.array(rows.column(c)) for c in ("pass", "passes", "usual", "agree"))
            credit = _log_miss(agree, usual)
            lost = np.where(needed > usual, _log_miss(agree, needed) - credit, 0.0)
            at = np.flatnonzero((needed > usual) | ((number == 0) & (passes * credit > math.log(CROWDED))))
            if len(at):
                ids = np.array(rows.column("cid"))[at].tolist()
                yield _edge_rows(ids, [None] * len(at), table.schema.field("embedding").type, lost[at], (passes * credit)[at])

        for batch in batches:
            if not batch.num_rows:
                continue
            for a in range(0, batch.num_rows, 4096):
                table = pa.Table.from_batches([batch.slice(a, 4096)])
                if seen < window:
                    first.append(table.slice(0, window - seen))
                seen += table.num_rows
                old = 0 if held is None else held.num_rows
                table = table if held is None else pa.concat_tables([held, table])
                for x, y in _linked(table.slice(max(0, old - window)), window, threshold):
                    united.join(x, y)
                if seen - window > done:
                    yield from crowd(table, seen - window)
                    done = seen - window
                held = table.slice(max(0, table.num_rows - 2 * window))
        if held is None:
            return
        yield from crowd(held, seen)
        for head, rows in ((True, pa.concat_tables(first)), (False, held.slice(max(0, held.num_rows - window)))):
            rows = rows.combine_chunks()
            yield _row(rows, part, head)
        lo, hi = united.edges()
        for a in range(0, len(lo), 10_000):
            yield _edge_rows(lo[a : a + 10_000], hi[a : a + 10_000], rows.schema.field("embedding").type)

    result = stage(ordered.mapInArrow(lean(compare), out_schema), "projection-passes", as_is=True)
    release(spark)
    border = result.filter("part IS NOT NULL")
    heads = border.filter("head").groupBy("part").count().collect()  # one number a task
    sent = spark.sparkContext.broadcast(_reaches({r["part"]: r["count"] for r in heads}, window))

    def reborder(batches):
        for batch in batches:
            part, head, pos = (np.array(batch.column(c)) for c in ("part", "head", "pos"))
            to = [sent.value[p][1] if h else [p] for p, h in zip(part.tolist(), head.tolist())]
            rows = np.repeat(np.arange(len(to)), [len(t) for t in to])
            place = np.where(head, [sent.value[p][0] for p in part.tolist()] + pos, pos)
            batch = batch.take(pa.array(rows))
            batch = batch.set_column(0, "part", pa.array([p for t in to for p in t], pa.int32()))
            yield batch.set_column(2, "pos", pa.array(place[rows], pa.int32()))

    def across(key, group):
        table = group.sort_by([("head", "ascending"), ("pos", "ascending")])
        split = int((~np.array(table.column("head"))).sum())
        united = _Union()
        for x, y in _linked(table, window, threshold, split, "a"):
            united.join(x, y)
        lo, hi = united.edges()
        return pa.table({"a": pa.array(lo, pa.int64()), "b": pa.array(hi, pa.int64())})

    edge = border.mapInArrow(reborder, out_schema).groupBy("part").applyInArrow(across, "a long, b long")
    return result.filter("part IS NULL").select("a", "b", "lost", "base").unionByName(edge, allowMissingColumns=True)


def _reaches(heads: dict[int, int], window: int) -> dict[int, tuple[int, list[int]]]:
    """For each partition, from the rows in its head: where its head's first row stands among all
    heads, and the partitions before it whose windows reach it, over short ones between."""
    parts = sorted(heads)
    out, at = {}, 0
    for k, part in enumerate(parts):
        before, between = [], 0
        for p in reversed(parts[:k]):
            if between >= window:
                break
            before.append(p)
            between += heads[p]
        out[part] = (at, before)
        at += heads[part]
    return out


def _linked(table: pa.Table, window: int, threshold: float, split: int | None = None, name: str = "cid"):
    """Pairs of ids of ordered rows that are near enough and similar."""
    group = np.stack([np.array(table.column(c)) for c in ("pass", "place", "dim")], axis=1)
    ids = np.array(table.column(name))
    dims = np.array(table.column("dim"))
    column = table.column("embedding").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    out = []
    for dim in np.unique(dims):
        own = np.flatnonzero(dims == dim)  # rows of one dimension are not always neighbours
        unit = _unit(_matrix(column.take(pa.array(own))))
        inner = None if split is None else int((own < split).sum())
        pairs = own[_window_pairs(group[own], unit, window, threshold, inner)]
        out += zip(ids[pairs[:, 0]].tolist(), ids[pairs[:, 1]].tolist())
    return out


def _row(rows: pa.Table, part: int, head: bool) -> pa.RecordBatch:
    n = rows.num_rows
    return pa.Table.from_arrays(
        [
            pa.array(np.full(n, part, np.int32)), pa.array([head] * n), pa.array(np.arange(n, dtype=np.int32)), rows.column("pass"),
            rows.column("place"), rows.column("dim"), rows.column("cid"), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), rows.column("embedding"),
        ],
        names=["part", "head", "pos", "pass", "place", "dim", "a", "b", "lost", "base", "embedding"],
    ).combine_chunks().to_batches()[0]


def _edge_rows(lo: list[int], hi: list[int | None], kind: pa.DataType, lost: np.ndarray | None = None, base: np.ndarray | None = None) -> pa.RecordBatch:
    n = len(lo)
    none = [pa.nulls(n, t) for t in (pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int32())]
    chances = [pa.nulls(n, pa.float64()) if x is None else pa.array(x, pa.float64()) for x in (lost, base)]
    return pa.RecordBatch.from_arrays(
        [*none, pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), *chances, pa.nulls(n, kind)],
        names=["part", "head", "pos", "pass", "place", "dim", "a", "b", "lost", "base", "embedding"],
    )


def _crowded(found: DataFrame) -> DataFrame:
    """(cid) of the rows that would miss a pair at the threshold with a chance above ``CROWDED``."""
    return (
        found.filter("b IS NULL").groupBy(F.col("a").alias("cid")).agg((F.sum("lost") + F.max("base")).alias("chance"))
        .filter(F.col("chance") > math.log(CROWDED)).select("cid")
    )


def _crowd_edges(classes: DataFrame, crowded: DataFrame, threshold: float) -> DataFrame:
    """(a, b) links between crowded rows and all classes of their label, exactly; a spanning set for
    each product of blocks."""
    rows = classes.select("place", "cid", "embedding", F.size("embedding").alias("dim"))
    own = stage(rows.join(crowded, "cid"), "crowd")
    number = lambda df, name: df.groupBy("place", "dim").agg(F.ceil(F.count("*") / CROWD_BLOCK).cast("int").alias(name))
    blocks = stage(number(own, "lefts").join(number(rows, "rights"), ["place", "dim"]), "crowd-blocks")

    def dealt(df, left):
        mine, others = ("lefts", "rights") if left else ("rights", "lefts")
        block = F.pmod(F.xxhash64("cid"), F.col(mine)).cast("int")
        all_others = F.explode(F.sequence(F.lit(0), F.col(others) - 1))
        return df.join(blocks, ["place", "dim"]).select(
            "place", "dim", (block if left else all_others).alias("i"), (all_others if left else block).alias("j"), F.lit(left).alias("left"), "cid", "embedding"
        )

    def product(key, group):
        left, ids = np.array(group.column("left")), np.array(group.column("cid"))
        column = group.column("embedding").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        unit = _unit(_matrix(column))
        node, at = np.unique(ids, return_inverse=True)
        root = np.arange(len(node))
        a, b = np.flatnonzero(left), np.flatnonzero(~left)
        for x in range(0, len(a), BLOCK):
            near = unit[a[x : x + BLOCK]] @ unit[b].T >= threshold
            for i in np.flatnonzero(near.any(axis=1)).tolist():
                joined = np.unique(np.append(root[at[b[near[i]]]], root[at[a[x + i]]]))
                if len(joined) > 1:
                    table = np.arange(len(node))
                    table[joined] = joined[0]
                    root = table[root]
        other = np.flatnonzero(root != np.arange(len(node)))
        return pa.table({"a": pa.array(node[root[other]], pa.int64()), "b": pa.array(node[other], pa.int64())})

    return dealt(own, True).unionByName(dealt(rows, False)).groupBy("place", "dim", "i", "j").applyInArrow(product, "a long, b long")


def _link_counts(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """(cid, links) within components: members are dealt into blocks by a hash, every pair of
    blocks of a component is one matrix product."""
    sizes = stage(members.groupBy("component").agg(F.count("*").alias("size")), "component-sizes")
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = (
        members.join(sizes, "component")
        .withColumn("own", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "copies", "embedding")
    )

    def product(key, group):
        i, j = key[1].as_py(), key[2].as_py()
        own, ids = np.array(group.column("own")), np.array(group.column("cid"))
        copies = np.array(group.column("copies"))
        column = group.column("embedding").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        unit = _unit(_matrix(column))
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        near = unit[a] @ unit[b].T >= threshold
        if i == j:
            np.fill_diagonal(near, False)
        links = np.zeros(len(ids), dtype=np.int64)
        links[a] += near @ copies[b]
        if i != j:
            links[b] += near.T @ copies[a]
        return pa.table({"cid": pa.array(ids, pa.int64()), "links": pa.array(links)})

    return dealt.groupBy("component", "i", "j").applyInArrow(product, "cid long, links long").groupBy("cid").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Only vectors of one label and one length are compared. NULL labels, NULL or zero vectors and
    vectors with NULL or non-finite components have no links and are their own component.
    Repeated rows are linked like other equal vectors."""
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding", "label")
    classes = stage(
        rows.filter(usable()).groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes",
    )
    # every label has a number of its own; one short row a label
    labels = stage(classes.select("label").distinct().withColumn("place", F.monotonically_increasing_id()), "labels")
    placed = classes.join(labels, "label")
    plans = _label_plans(placed, threshold, window)
    placed = stage(placed.withColumn("dim", F.size("embedding")).join(plans, ["place", "dim"]).select("place", "cid", "embedding", "passes", "usual", "centre"), "placed")
    found = stage(_edges(placed, 0, window, threshold), "links")
    crowded = stage(_crowded(found).unionByName(placed.filter("passes = 0").select("cid")), "crowded")
    edges = found.filter("b IS NOT NULL").select("a", "b")
    if crowded.first() is not None:
        edges = edges.unionByName(_crowd_edges(placed, crowded, threshold))
    edges = stage(edges, "all-links")
    joined = stage(connected_components(edges, "a", "b").withColumnRenamed("node", "cid"), "components")
    members = stage(classes.join(joined, "cid"), "members")
    counts = stage(_link_counts(members, threshold, BLOCK), "link-counts")
    smallest = stage(members.groupBy("component").agg(F.min("rep").alias("component_id")), "smallest")
    named = stage(
        classes.join(joined, "cid", "left").join(smallest, "component", "left").join(counts, "cid", "left")
        .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")),
        "named",
    )
    unstage(classes, labels, plans, placed, found, crowded, edges, joined, members, counts, smallest)
    release(spark)
    out = (
        rows.filter(usable()).join(named, ["label", "embedding"], "left").select("vec_id", "n_links", "component_id")
        .unionByName(rows.filter(~usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    )
    return few_files(out).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op10_embeddings(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector; odd rows as in :func:`near_duplicates`."""
    return near_duplicates(vectors)
