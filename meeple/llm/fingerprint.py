"""Context-triggered piecewise hashing of texts (operator 6).

A rolling hash over the last ``WINDOW`` code points ends a chunk wherever its low bits are all
ones; every chunk gives one of 64 characters. The number of bits (the block size) follows the
text's length, so that a signature has about 32 to 64 characters; a second signature uses
twice the block size. Two fingerprints are compared at equal block sizes, by edit distance
(insertions and deletions cost 1, replacements 2), if their signatures share ``COMMON``
characters in a row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meeple.llm.common import SpanHasher, code_points, lean, map_slices, mix64, release, row_ids, ship_code, slices, stage

WINDOW = 7
LEAST_BLOCK = 2
LENGTH = 64
COMMON = 5
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_WEIGHTS = [np.uint64(int(w) | 1) for w in np.random.default_rng(77).integers(1, 2**63, size=WINDOW)]


def fingerprints(texts: list[str]) -> list[str]:
    """``block:signature:signature at twice the block`` of every text."""
    if not texts:
        return []
    pad = "\0" * WINDOW
    cp, offsets = code_points([t + pad for t in texts])
    length = np.diff(offsets) - WINDOW
    code = mix64(cp.astype(np.uint64) + np.uint64(1))
    inside = np.ones(len(cp), dtype=bool)
    for k in range(WINDOW):
        inside[offsets[1:] - 1 - k] = False
    code[~inside] = 0
    rolling = code * _WEIGHTS[0]
    for k in range(1, WINDOW):
        rolling[k:] += code[:-k] * _WEIGHTS[k]
    rolling = mix64(rolling)
    # a chunk of block size 2**k ends where the k lowest bits are ones; few places have many
    block = np.full(len(texts), LEAST_BLOCK, dtype=np.int64)
    while (low := block * LENGTH < length).any():
        block[low] *= 2
    floor = np.repeat((np.maximum(block // 4, LEAST_BLOCK) - 1).astype(np.uint64), np.diff(offsets))
    ends = np.flatnonzero(((rolling & floor) == floor) & inside)
    value = rolling[ends]
    first = np.searchsorted(ends, offsets)
    hasher = SpanHasher(code)
    out = []
    for i in range(len(texts)):
        start, n, b = int(offsets[i]), int(length[i]), int(block[i])
        at, bits = ends[first[i] : first[i + 1]] + 1, value[first[i] : first[i + 1]]
        own = at[(bits & np.uint64(b - 1)) == np.uint64(b - 1)]
        while len(own) < LENGTH // 2 and b > LEAST_BLOCK:
            b //= 2
            if b < max(int(block[i]) // 4, LEAST_BLOCK):  # below the places found above
                hits = (rolling[start : start + n] & np.uint64(b - 1)) == np.uint64(b - 1)
                own = start + np.flatnonzero(hits) + 1
            else:
                own = at[(bits & np.uint64(b - 1)) == np.uint64(b - 1)]
        wide = np.uint64(2 * b - 1)
        twice = own[(rolling[own - 1] & wide) == wide]
        out.append(f"{b}:{_signature(hasher, start, n, own, LENGTH)}:{_signature(hasher, start, n, twice, LENGTH // 2)}")
    return out


def _signature(hasher: SpanHasher, start: int, n: int, ends: np.ndarray, limit: int) -> str:
    """One character a chunk; the last one covers all that is left of the text."""
    if not n:
        return ""
    stop = np.append(ends[: limit - 1], start + n)
    begin = np.append(start, stop[:-1])
    full = stop > begin  # a text may end with a chunk
    h = hasher(begin[full], stop[full]) >> np.uint64(58)
    return "".join([ALPHABET[c] for c in h.tolist()])


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, all of one row at a time in the bits of an int."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _signature_likeness(a: str, b: str) -> float:
    """1 - distance / (both lengths), 0 unless the signatures share COMMON characters in a row."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    runs = {a[i : i + COMMON] for i in range(len(a) - COMMON + 1)}
    if not any(b[i : i + COMMON] in runs for i in range(len(b) - COMMON + 1)):
        return 0.0
    return 2.0 * _common_subsequence(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1; equal fingerprints 1, block sizes that differ by more than a factor of two 0."""
    if a == b:
        return 1.0
    (x, x1, x2), (y, y1, y2) = a.split(":"), b.split(":")
    x, y = int(x), int(y)
    if x == y:
        return max(_signature_likeness(x1, y1), _signature_likeness(x2, y2))
    if x == 2 * y:
        return _signature_likeness(x1, y2)
    if y == 2 * x:
        return _signature_likeness(x2, y1)
    return 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COLUMNS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(ids: list, texts: list[str], following: list[str], own: list[str], nxt: list[str]) -> dict:
    changed = [edited(t, f) for t, f in zip(texts, following)]
    prints: list[str] = []
    for a, b in slices(map(len, changed)):
        prints += fingerprints(changed[a:b])
    return {
        "doc_id": ids, "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(c.encode()).hexdigest() for c in changed],
        "fingerprint": own, "edited_fingerprint": prints,
        "near_edited": [likeness(a, b) for a, b in zip(own, prints)],
        "near_next": [likeness(a, b) for a, b in zip(own, nxt)],
    }


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every text, with no shuffle. NULL texts: as empty."""
    def run(texts, rows):
        return {"doc_id": row_ids(rows), "n_chars": [len(t) for t in texts], "fingerprint": fingerprints(texts)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_slices(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_chars long, fingerprint string")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text (last half from the next document, by
    doc_id, NULL first, then by the text's hash and the text; after the last comes the first), and
    their likeness.

    The texts are range-shuffled once, by id and hash, so that different texts of one id spread. A task sees its rows in order and answers all but its
    last one, whose successor opens the next task's range: those few are joined afterwards."""
    spark = docs.sparkSession
    ship_code(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    ranges = [F.col("doc_id").asc_nulls_first(), F.col("_hash").asc()]
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    ordered = hashed.repartitionByRange(n, *ranges).sortWithinPartitions(*ranges, F.col("text").asc_nulls_first()).select("doc_id", "text")
    schema = f"doc_id {kind}, {_COLUMNS}, part int, head string, tail string"

    def run(batches):
        part = TaskContext.get().partitionId()
        held = None  # (id, text, fingerprint) of the row before
        arrow = None

        def batch_of(columns, head=None, tail=None, size=1):
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            kinds = [arrow, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            data = [pa.array(columns[c], k) if columns else pa.nulls(size, k) for c, k in zip(names, kinds)]
            if not columns:
                data[0] = pa.array([tail[0]], arrow) if tail else pa.nulls(size, arrow)
            edge = head is not None or tail is not None
            return pa.RecordBatch.from_arrays(
                [*data, pa.array([part] * size, pa.int32()) if edge else pa.nulls(size, pa.int32()),
                 pa.array([head], pa.string()) if head is not None else pa.nulls(size, pa.string()),
                 pa.array([tail[1]], pa.string()) if tail is not None else pa.nulls(size, pa.string())],
                names=[*names, "part", "head", "tail"],
            )

        for batch in batches:
            arrow = batch.column(0).type
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(map(len, texts)):
                own = fingerprints(texts[a:b])
                if held is None:
                    yield batch_of(None, head=texts[a])
                    before = ([], [], [])
                else:
                    before = tuple([x] for x in held)
                some_ids, some, prints = before[0] + ids[a:b], before[1] + texts[a:b], before[2] + own
                held = (some_ids[-1], some[-1], prints[-1])
                if len(some) > 1:
                    yield batch_of(_rows(some_ids[:-1], some[:-1], some[1:], prints[:-1], prints[1:]), size=len(some) - 1)
        if held is not None:
            yield batch_of(None, tail=held[:2])

    done = stage(ordered.mapInArrow(lean(run), schema), "fingerprints", as_is=True)
    release(spark)
    parts = sorted(r["part"] for r in done.filter("part IS NOT NULL").select("part").distinct().collect())  # one number a task
    step = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, following int") if parts else None
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    finished = done.filter("part IS NULL").select(*columns)
    if step is None:
        return finished
    last = (
        done.filter("tail IS NOT NULL").select("doc_id", "tail", "part").join(step, "part")
        .join(done.filter("head IS NOT NULL").select(F.col("part").alias("following"), "head"), "following").select("doc_id", "tail", "head")
    )

    def close(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                text, nxt = row.column(1)[0].as_py(), row.column(2)[0].as_py()
                got = _rows(None, [text], [nxt], fingerprints([text]), fingerprints([nxt]))
                yield pa.RecordBatch.from_arrays([row.column(0), *(pa.array(got[c]) for c in columns[1:])], names=columns)

    return finished.unionByName(last.mapInArrow(close, f"doc_id {kind}, {_COLUMNS}"))


def op6_fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of
    every document.

    NULL texts are empty ones. Rows with equal ids are ordered by the text's hash, NULL ids come first; a
    single row follows itself. Equal fingerprints, empty ones too, have likeness 1. Other columns
    are not read; no rows give no rows."""
    return compare_with_next(docs)
