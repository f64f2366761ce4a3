"""Helpers shared by the corpus operators.

Texts are handled as UTF-8 bytes or code points in numpy, a bounded number of characters at
a time (:func:`slices`), so the memory of a task does not depend on the batch size. Results
that are read more than once are written below the cluster's shared folder (:func:`stage`).
"""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import meeple
from meeple.session import unique_path

FILES_PER_CORE = 4
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
CHARS_PER_SLICE = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(modulus: int, col: str = "doc_id"):
    """crc32 of the id as text, modulo ``modulus`` (NULL id: NULL)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % modulus


def in_fold(modulus: int, remainder: int, col: str = "doc_id"):
    """True where :func:`fold` equals ``remainder``; a NULL id is in no fold."""
    return F.coalesce(fold(modulus, col) == remainder, F.lit(False))


def stage(df: DataFrame, label: str, as_is: bool = False) -> DataFrame:
    """``df`` written below the shared folder and read back: the lineage ends here, and a lost
    executor costs only its unfinished tasks. ``as_is`` keeps one task for each partition, which
    a frame needs whose functions use the number of their task."""
    spark = df.sparkSession
    path = unique_path(spark, "llm", label)
    (df if as_is else few_files(df)).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def few_files(df: DataFrame) -> DataFrame:
    """``df`` in a few partitions for each core at most, to be written: a task works through several
    partitions one after another rather than leave a tiny file of each."""
    return df.coalesce(FILES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


def unstage(*frames: DataFrame) -> None:
    """Delete what :func:`stage` wrote for these frames; they can't be read afterwards."""
    for df in frames:
        path = getattr(df, "_staged_path", None)
        if path:
            jvm = df.sparkSession._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            conf = df.sparkSession._jsc.hadoopConfiguration()
            target.getFileSystem(conf).delete(target, True)


#: Rows of an Arrow batch. Spark's default of 10,000 suits narrow rows; so many whole texts, in
#: the executor's and the worker's memory at once, may be gigabytes.
ROWS_PER_BATCH = 500


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of any cluster (once per context), and
    Arrow batches small enough for texts where the session has Spark's default."""
    sc = spark.sparkContext
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, str(ROWS_PER_BATCH))
    if getattr(sc, "_meeple_shipped", False):
        return
    root = Path(meeple.__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="meeple-code-")) / "meeple_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._meeple_shipped = True


def lean(function):
    """A mapInArrow function that gives freed memory back to the system when its task ends: Python
    workers are kept for later tasks, beside the executor's own memory."""

    @functools.wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back_memory()

    return run


def give_back_memory() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not a GNU C library
        pass


def slices(lengths: Iterable[int], limit: int = CHARS_PER_SLICE) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges (start, end) with at most ``limit`` characters each; a longer
    text is a range of its own."""
    start, total, i = 0, 0, -1
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if i >= start:
        yield start, i + 1


def map_slices(
    df: DataFrame,
    compute: Callable[[list[str], pa.RecordBatch], dict[str, object]],
    schema: str,
    text: str = "text",
    limit: int = CHARS_PER_SLICE,
) -> DataFrame:
    """``compute(texts, rows)`` over slices of Arrow batches of ``df``; it returns one array per
    column of ``schema``. NULL texts arrive as empty ones."""
    spark = df.sparkSession
    ship_code(spark)
    names = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    arrow = _arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for a, b in slices(text_bytes(column), limit):
                out = compute([t or "" for t in column.slice(a, b - a).to_pylist()], batch.slice(a, b - a))
                columns = [_as_arrow(out[n], arrow.field(n).type) for n in names]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(lean(run), schema)


def text_bytes(column: pa.Array) -> list[int]:
    """UTF-8 bytes of each text (NULL: 0)."""
    return pc.binary_length(column).fill_null(0).to_pylist()


def _as_arrow(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def row_ids(batch: pa.RecordBatch, name: str = "doc_id") -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


# --- code points and words -----------------------------------------------------------------


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points one after another, and len(texts)+1 offsets into them."""
    cp = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return cp, offsets


_RNG = np.random.default_rng(20240117)
BYTE_CODES = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(base: int, name: str, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        out = np.empty(size, dtype=np.uint64)
        out[0] = 1
        done = 1
        while done < size:  # powers double in length: out[k:2k] = out[:k] * base**k
            step = min(done, size - done)
            out[done : done + step] = out[:step] * np.uint64(pow(base, done, 2**64))
            done += step
        if size <= 1 << 22:
            _POWERS[name] = out
        have = out
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (every input bit reaches every output bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def lower_ascii(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts, A-Z lower-cased, each followed by one blank; and the offset of
    each text (len+1 entries)."""
    raw = [t.encode("utf-8").lower() for t in texts]
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=offsets[1:])
    return np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8) if raw else np.zeros(0, np.uint8), offsets


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (maximal runs without ASCII white space, A-Z lower-cased),
    in order, and the first word of each text (len+1 offsets)."""
    data, offsets = lower_ascii(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    starts, ends = runs(~_WHITE[data])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    hashes = SpanHasher(BYTE_CODES[data])(starts, ends)
    return hashes, np.searchsorted(starts, offsets)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of True."""
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if mask[0]:
        edge = np.concatenate([[0], edge])
    if len(edge) % 2:
        edge = np.concatenate([edge, [len(mask)]])
    return edge[0::2], edge[1::2]


class SpanHasher:
    """64-bit hashes of spans of ``codes`` (uint64 values): a polynomial modulo 2**64 by prefix
    sums, shifted to the span's start, mixed with the span's length."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.prefix = np.empty(n + 1, dtype=np.uint64)
        self.prefix[0] = 0
        np.cumsum(codes * _powers(_BASE, "up", n), out=self.prefix[1:])
        self.down = _powers(_BASE_INVERSE, "down", n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self.prefix[ends] - self.prefix[starts]) * self.down[starts]
        return mix64(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def letters(cp: np.ndarray) -> np.ndarray:
    """Mask of letters: ASCII by range, everything else by Python's character classes."""
    mask = ((cp | 32) >= 97) & ((cp | 32) <= 122)
    high = cp >= 128
    if high.any():
        kinds = np.unique(cp[high])
        good = np.array([chr(c).isalpha() for c in kinds])
        mask[high] = good[np.searchsorted(kinds, cp[high])]
    return mask


def lowered(cp: np.ndarray) -> np.ndarray:
    """Lower-case code points, one for one."""
    out = cp.copy()
    out[(cp >= 65) & (cp <= 90)] += 32
    out[(cp >= 0xC0) & (cp <= 0xDE) & (cp != 0xD7)] += 32
    high = out >= 0x100
    if high.any():
        kinds = np.unique(out[high])
        low = np.array([ord(chr(c).lower()[0]) for c in kinds], dtype=np.uint32)
        out[high] = low[np.searchsorted(kinds, out[high])]
    return out


# --- connected components -------------------------------------------------------------------


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Alternating large-star and small-star steps: every node's neighbours are linked to the
    smallest one, until only stars are left. Minima are map-side combined and written, so that
    the join back on a node with very many neighbours is a plain join of two shuffles, which
    adaptive execution can split.
    """
    cur = stage(
        edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).filter("lo < hi").distinct(), "cc"
    )
    while not _only_stars(cur):
        both = cur.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            cur.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        )
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc")
        large = stage(
            both.filter("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct(),
            "cc",
        )
        lowest = stage(large.groupBy("hi").agg(F.min("lo").alias("m")), "cc")
        small = large.join(lowest, "hi").filter("lo <> m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        nxt = stage(small.unionByName(lowest.select(F.col("m").alias("lo"), "hi")).distinct(), "cc")
        unstage(least, large, lowest, cur)
        cur = nxt
    out = cur.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        cur.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
    out._staged_path = cur._staged_path  # unstage() frees it
    return out


def _only_stars(edges: DataFrame) -> bool:
    """No node has two smaller neighbours, or a smaller and a larger one."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("lo").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are out of reach. It does so after a
    collection of the driver's heap, which on a large heap may be hours away."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Bytes of packed data that a hash shard holds on average, in one task's memory at a time.
SHARD_BYTES = 64 << 20


def shards(spark: SparkSession, per_partition: int = 4, n_bytes: int = 0) -> int:
    """Number of hash shards that about ``n_bytes`` are packed into for one shuffle."""
    cores = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(per_partition * cores, -(-n_bytes // SHARD_BYTES))


def text_bytes_of(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts (one scan of the column)."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def numbered(docs: DataFrame, columns: list[str], name: str = "_row") -> DataFrame:
    """``columns`` and a number ``name`` that tells all rows apart, the same in every scan however
    the files are split: a hash of the file's name, free of collisions among the files at hand,
    and the row's place in the file. A frame that is no plain scan of files is written first."""
    try:
        placed = docs.select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias(name))
    except AnalysisException:
        return numbered(stage(docs.select(*columns), "numbered-rows"), columns, name)
    files = stage(placed.groupBy("_file").agg(F.max(name).alias("last")), "files")
    bits = int(files.agg(F.max("last")).first()[0] or 0).bit_length()
    seed, n = 0, files.count()
    number = lambda: F.pmod(F.xxhash64(F.lit(seed), "_file"), F.lit(1 << (62 - bits)))
    while files.select(number()).distinct().count() < n:
        seed += 1
    unstage(files)
    return placed.withColumn(name, number() * F.lit(1 << bits) + F.col(name)).drop("_file")


def batches_of(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[tuple[int, list[str], pa.RecordBatch]]:
    """(batch number, texts, rows): a task's rows in consecutive batches of about ``limit``
    characters, at most 65,536 rows each. ``batches`` have a column ``part``, the number of their
    partition (``spark_partition_id``; a task may work through several): batch numbers are unique
    in the frame, and a task that runs again makes the same batches."""
    number = None
    held: list[pa.RecordBatch] = []
    texts: list[str] = []
    size = 0

    def flush():
        return number, texts, pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        if number is None:
            number = batch.column(batch.schema.get_field_index("part"))[0].as_py() << 32
        column = batch.column(batch.schema.get_field_index(text))
        rest = batch.drop_columns([text, "part"])
        for a, b in slices(text_bytes(column), min(limit, CHARS_PER_SLICE)):
            for c in range(a, b, 1 << 15):
                d = min(b, c + (1 << 15))
                if texts and (size >= limit or len(texts) + d - c > 1 << 16):
                    yield flush()
                    number += 1
                    held, texts, size = [], [], 0
                held.append(rest.slice(c, d - c))
                got = [t or "" for t in column.slice(c, d - c).to_pylist()]
                texts += got
                size += sum(map(len, got))
    if texts:
        yield flush()
