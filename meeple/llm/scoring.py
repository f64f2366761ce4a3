"""Language-model scores from a log-frequency Bloom filter (operator 4).

All training texts are counted, by hash shards in one shuffle: words exactly, and pairs of
neighbouring words. A count c is kept as its logarithm, level floor(log2(c)); the filter holds
every n-gram seen in training, once for each level from 0 up to its own. A count is read back by
probing levels 0, 1, ... until one is absent; probabilities interpolate the pair's and the word's
counts.

The filter grows with what was seen: each shard has a region of bits that its n-grams fill to one
half. It is broadcast in segments of ``SEGMENT_BYTES`` at most, each the regions of some shards. The
texts are read once: a task takes the distinct n-grams of a group of texts, sorted by shard, and
looks each up in the one segment that has its shard, with one segment in memory at a time.

The same shuffle gives the exact add-one unigram score: a shard knows the counts of its words
and answers each batch of texts with their partial sums.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meeple.llm.common import (
    CHARS_PER_SLICE, few_files, give_back_memory, in_fold, lean, mix64, release, shards, ship_code, slices, stage, text_bytes, text_bytes_of,
    word_hashes,
)

#: Bytes of one broadcast of the filter (a shard's region is never divided).
SEGMENT_BYTES = 64 << 20
#: UTF-8 bytes of texts that a task looks up together where there are several segments.
HELD_BYTES = 16 << 20
#: Bytes of packed words and pairs for each byte of text, about.
_PACKED = 3
#: Probes of an n-gram's first level and of every further one.
FIRST_PROBES, MORE_PROBES = 6, 2
#: Weight of the pair's relative frequency where the first word is known.
PAIR_WEIGHT = 0.6

_END, _START = np.uint64(0x452821E638D01377), np.uint64(0xBE5466CF34E90C6C)
_W1, _W2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.uint64((1 << 40) - 1)
_WORD, _PAIR = 1, 2
_BATCH_CHARS = 8 << 20
#: Rows of a batch: its number is the stored row number without the lowest bits, which are the place.
_BATCH_BITS = 14


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's words, each text followed by one end token; and the offset of each
    text's first token (len+1 entries)."""
    words, offsets = word_hashes(texts)
    n = len(texts)
    out = np.full(len(words) + n, _END, dtype=np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(offsets))] = words
    return out, offsets + np.arange(n + 1)


def pairs(token: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it (a start mark before a text's first)."""
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[offsets[:-1]] = _START
    return mix64(before * _W1 + mix64(token * _W2))


def _shard(grams: np.ndarray, n_shards: int) -> np.ndarray:
    return ((grams >> np.uint64(40)) % np.uint64(n_shards)).astype(np.int64)


def _bytewise(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts as bytes; a larger one becomes several entries. Returns (repeats, bytes)."""
    repeats = -(-counts // 255)
    out = np.full(int(repeats.sum()), 255, dtype=np.uint8)
    last = np.cumsum(repeats) - 1
    out[last] = counts - 255 * (repeats - 1)
    return repeats, out


def _pack_words(token: np.ndarray, doc: np.ndarray, train: np.ndarray, n_shards: int) -> dict[int, bytes]:
    """By shard: each word's hash, its training count, and its (text, count) postings."""
    order = np.argsort(token, kind="stable")  # texts stay in order within a word
    t, d = token[order], doc[order]
    edge = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (d[1:] != d[:-1])]))
    word, text = t[edge], d[edge]
    tf = np.diff(np.append(edge, len(t)))
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    seen = np.add.reduceat(tf * train[text], first)
    repeats, tf8 = _bytewise(tf)
    text = np.repeat(text, repeats)
    entries = np.add.reduceat(repeats, first)
    word = word[first]
    shard = _shard(word, n_shards)
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(n_shards + 1))
    start = np.concatenate([[0], np.cumsum(entries)])
    out = {}
    for s in np.flatnonzero(np.diff(bounds)):
        own = order[bounds[s] : bounds[s + 1]]
        at = _ranges(start[own], entries[own])
        out[int(s)] = b"".join([
            np.array([len(own), len(at)], np.int64).tobytes(), word[own].tobytes(), seen[own].astype(np.uint32).tobytes(),
            entries[own].astype(np.uint32).tobytes(), text[at].astype(np.uint16).tobytes(), tf8[at].tobytes(),
        ])
    return out


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated aranges."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _unpack_words(data: bytes):
    n, m = (int(x) for x in np.frombuffer(data, np.int64, 2))
    at = 16
    word = np.frombuffer(data, np.uint64, n, at)
    seen = np.frombuffer(data, np.uint32, n, at + 8 * n)
    entries = np.frombuffer(data, np.uint32, n, at + 12 * n)
    text = np.frombuffer(data, np.uint16, m, at + 16 * n)
    return word, seen, entries, text, np.frombuffer(data, np.uint8, m, at + 16 * n + 2 * m)


def _pack_pairs(grams: np.ndarray, n_shards: int) -> dict[int, bytes]:
    """By shard: 40 bits and a count byte for each distinct pair."""
    gram, count = np.unique(grams, return_counts=True)
    repeats, count8 = _bytewise(count)
    gram = np.repeat(gram, repeats)
    shard = _shard(gram, n_shards)
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(n_shards + 1))
    low = (gram & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = ((gram >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8)
    out = {}
    for s in np.flatnonzero(np.diff(bounds)):
        own = order[bounds[s] : bounds[s + 1]]
        out[int(s)] = b"".join([np.array([len(own)], np.int64).tobytes(), low[own].tobytes(), high[own].tobytes(), count8[own].tobytes()])
    return out


def _unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    low = np.frombuffer(data, np.uint32, n, 8).astype(np.uint64)
    high = np.frombuffer(data, np.uint8, n, 8 + 4 * n).astype(np.uint64)
    return low | high << np.uint64(32), np.frombuffer(data, np.uint8, n, 8 + 5 * n)


def _levels(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64)


@dataclass
class CountFilter:
    """The broadcast filter, or some shards' part of it: n-gram -> quantised training count."""

    bits: np.ndarray  # uint8, the shards' regions one after another
    region: int | np.ndarray  # bits of each shard's region, 0 for a shard that is not here
    n_shards: int
    least: int  # smallest count that is kept
    tokens: int  # N
    words: int  # V
    texts: int

    def marks(self, grams: np.ndarray, kind: int) -> np.ndarray:
        """1 + the highest level found for each n-gram, 0 where the first one is absent."""
        unique, at = np.unique(grams, return_inverse=True)
        return self.probe(unique, kind)[at]

    def probe(self, unique: np.ndarray, kind: int) -> np.ndarray:
        """:meth:`marks` of different n-grams."""
        mark = np.zeros(len(unique), dtype=np.uint8)
        shard, key = _shard(unique, self.n_shards), unique & _LOW
        region = np.broadcast_to(np.asarray(self.region, dtype=np.int64), self.n_shards)
        start = np.cumsum(region) - region
        alive = np.flatnonzero(region[shard] > 0)
        first = j = int(math.log2(self.least))
        while len(alive) and j < 64:
            for i in range(FIRST_PROBES if j == first else MORE_PROBES):
                own = shard[alive]
                where = start[own] + _places(0, key[alive], kind, j, i, region[own])
                alive = alive[(self.bits[where >> 3] >> (where & 7).astype(np.uint8)) & 1 > 0]
            mark[alive] = j + 1
            j += 1
        return mark

    def counts(self, grams: np.ndarray, kind: int) -> np.ndarray:
        """Estimated counts, 0 where the first level is absent."""
        return _estimate(self.marks(grams, kind))

    def likelihood(self, word_marks: np.ndarray, pair_marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 probability of every text from the marks of its words and pairs."""
        own = _estimate(word_marks)
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[offsets[:-1]] = self.texts
        pair = np.minimum(_estimate(pair_marks), np.maximum(own, self.least))
        alone = (own + 1) / (self.tokens + self.words + 1)
        ratio = np.where(before > 0, np.minimum(pair / np.maximum(before, 1), 1.0), 0.0)
        weight = np.where(before > 0, PAIR_WEIGHT, 0.0)
        p = np.minimum(weight * ratio + (1 - weight) * alone, 1.0)
        return np.add.reduceat(np.log10(p), offsets[:-1])


def _estimate(marks: np.ndarray) -> np.ndarray:
    """Counts that stand for the marks: the middle of a level on the log scale; level 0 is 1."""
    middle = 2.0 ** (marks.astype(np.float64) - 0.5)
    return np.where(marks > 1, middle, (marks > 0).astype(np.float64))


def _places(shard, key, kind: int, level: int, probe: int, region: int) -> np.ndarray:
    salt = np.uint64(((kind * 64 + level) * 64 + probe) * 0xA0761D6478BD642F % 2**64)
    return shard * region + (mix64(key ^ salt) % np.asarray(region, dtype=np.uint64)).astype(np.int64)


def _region(grams: list[tuple[int, np.ndarray, np.ndarray]]) -> bytes:
    """A shard's region for (kind, keys, counts): bits that these fill to one half."""
    levels = [_levels(counts) for _, _, counts in grams]
    probes = sum(FIRST_PROBES * len(level) + MORE_PROBES * int(level.sum()) for level in levels)
    region = (math.ceil(probes / math.log(2)) + 7) // 8 * 8
    bits = np.zeros(region, dtype=np.uint8)
    for (kind, key, _), level in zip(grams, levels):
        for j in range(int(level.max(initial=-1)) + 1):
            own = key[level >= j]
            for i in range(FIRST_PROBES if j == 0 else MORE_PROBES):
                bits[_places(0, own, kind, j, i, region)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _batches(batches):
    """(batch number, places, texts, rows) of consecutive rows of one batch, about ``_BATCH_CHARS``
    characters at most; a batch may come in several pieces, also in several tasks. ``batches`` have
    the columns ``row``, the stored number, and ``text``."""
    number, held, places, texts, size = None, [], [], [], 0

    def flush():
        return number, np.concatenate(places), texts, pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        row = batch.column("row").to_numpy()
        column = batch.column("text")
        rest = batch.drop_columns(["row", "text"])
        own = row >> _BATCH_BITS
        edges = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(row)]
        for x, y in zip(edges, edges[1:]):
            for a, b in slices(text_bytes(column.slice(x, y - x)), CHARS_PER_SLICE):
                a, b = x + a, x + b
                if texts and (size >= _BATCH_CHARS or number != own[a]):
                    yield flush()
                    held, places, texts, size = [], [], [], 0
                number = int(own[a])
                held.append(rest.slice(a, b - a))
                places.append(row[a:b] & ((1 << _BATCH_BITS) - 1))
                got = [t or "" for t in column.slice(a, b - a).to_pylist()]
                texts += got
                size += sum(map(len, got))
    if texts:
        yield flush()


def _count(docs: DataFrame, n_shards: int) -> DataFrame:
    """One shuffle of packed words and pairs; rows of two kinds come back (see ``answer``):
    partial sums of a batch's texts, and the shard's region of the filter."""

    def pack(batches):
        for number, place, texts, rows in _batches(batches):
            train = np.zeros(1 << _BATCH_BITS, dtype=np.int64)
            train[place] = rows.column("train").fill_null(False).to_pylist()
            words, spans, doc = [], [], []
            for a in range(0, len(texts), 256):
                token, offsets = tokens(texts[a : a + 256])
                words.append(token)
                doc.append(np.repeat(place[a : a + 256], np.diff(offsets)))
                spans.append(pairs(token, offsets))
            token, doc, pair = np.concatenate(words), np.concatenate(doc), np.concatenate(spans)
            by_word = _pack_words(token, doc, train, n_shards)
            by_pair = _pack_pairs(pair[train[doc] > 0], n_shards)
            for s in sorted({*by_word, *by_pair}):
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([s], pa.int32()), "batch": pa.array([number], pa.int64()),
                    "words": pa.array([by_word.get(s)], pa.binary()), "pairs": pa.array([by_pair.get(s)], pa.binary()),
                })

    def answer(key, group):
        shard = key[0].as_py()
        batch = group.column("batch").to_pylist()
        parts = [(b, *_unpack_words(w)) for b, w in zip(batch, group.column("words").to_pylist()) if w]
        out = []
        word = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.uint64)
        seen = np.concatenate([p[2] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
        unique, at = np.unique(word, return_inverse=True)
        count = np.bincount(at, weights=seen, minlength=len(unique)).astype(np.int64)
        log, i = np.log10(count + 1.0), 0
        for b, w, _, entries, text, tf in parts:
            own = np.repeat(at[i : i + len(w)], entries)
            i += len(w)
            total = np.bincount(text, weights=log[own] * tf)
            known = np.bincount(text, weights=(count[own] > 0) * tf.astype(np.float64))
            which = np.flatnonzero(np.bincount(text))
            out.append((0, b, b"".join([np.array([len(which)], np.int64).tobytes(), total[which].tobytes(), known[which].astype(np.uint32).tobytes(), which.astype(np.uint16).tobytes()]), 0, 0))
        pair_parts = [_unpack_pairs(p) for p in group.column("pairs").to_pylist() if p]
        grams = np.concatenate([p[0] for p in pair_parts]) if pair_parts else np.zeros(0, np.uint64)
        pair, at = np.unique(grams, return_inverse=True)
        n = np.concatenate([p[1] for p in pair_parts]) if pair_parts else np.zeros(0, np.uint8)
        pair_count = np.bincount(at, weights=n, minlength=len(pair)).astype(np.int64)
        seen_words = count > 0
        bits = _region([(_WORD, unique[seen_words] & _LOW, count[seen_words]), (_PAIR, pair, pair_count)])
        out.append((1, shard, bits, int(count.sum()), int(seen_words.sum())))
        columns = list(zip(*out))
        give_back_memory()
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "batch", "data", "n", "v"])

    packed = docs.select("row", "train", "text").mapInArrow(lean(pack), "shard int, batch long, words binary, pairs binary")
    return packed.groupBy("shard").applyInArrow(answer, "kind int, batch long, data binary, n long, v long")


def _segments(answers: DataFrame, n_shards: int, texts: int):
    """The filter in parts of whole shards, of ``SEGMENT_BYTES`` at most (or one shard): a list with
    the first and last shard of each, and a function that fetches the part."""
    regions = answers.filter("kind = 1")
    rows = regions.select("batch", F.octet_length("data").alias("size"), "n", "v").collect()  # one small row a shard
    size = np.zeros(n_shards, dtype=np.int64)
    for r in rows:
        size[r["batch"]] = r["size"]
    n_tokens, n_words = sum(r["n"] for r in rows), sum(r["v"] for r in rows)
    bounds, held = [0], 0
    for s in range(n_shards):
        if held and held + size[s] > SEGMENT_BYTES:
            bounds.append(s)
            held = 0
        held += int(size[s])
    bounds.append(n_shards)

    def fetch(a: int, b: int) -> CountFilter:
        own = np.zeros(n_shards, dtype=np.int64)
        own[a:b] = size[a:b]
        start = np.cumsum(own) - own
        bits = np.zeros(int(own.sum()), dtype=np.uint8)
        # at most SEGMENT_BYTES in all
        for r in regions.filter(F.col("batch").between(a, b - 1)).select("batch", "data").collect():
            bits[start[r["batch"]] : start[r["batch"]] + own[r["batch"]]] = np.frombuffer(bytes(r["data"]), np.uint8)
        return CountFilter(bits, own * 8, n_shards, 1, n_tokens, n_words, texts)

    return list(zip(bounds, bounds[1:])), fetch


def _chunks(batches):
    """(batch number, places, rows, texts) of up to 256 rows of a batch."""
    for number, place, texts, rows in _batches(batches):
        for a in range(0, len(texts), 256):
            yield number, place[a : a + 256], rows.slice(a, 256), texts[a : a + 256]


def _groups(chunks, limit: int):
    """Lists of consecutive chunks with about ``limit`` characters."""
    held, size = [], 0
    for chunk in chunks:
        held.append(chunk)
        size += sum(map(len, chunk[3]))
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _look_up(grams: list[tuple[np.ndarray, int]], filters) -> list[np.ndarray]:
    """Marks of n-grams of several kinds from the segments ((first, last shard), broadcast) of the
    filter. An n-gram is probed in the segment of its shard only; with several segments, one is in
    memory at a time."""
    found = []
    n_shards = filters[0][1].value.n_shards
    for gram, kind in grams:
        unique, at = np.unique(gram, return_inverse=True)
        shard = _shard(unique, n_shards)
        order = np.argsort(shard, kind="stable")
        found.append((unique, at, kind, order, shard[order], np.zeros(len(unique), dtype=np.uint8)))
    for (first, last), sent in filters:
        for unique, _, kind, order, shard, mark in found:
            lo, hi = np.searchsorted(shard, [first, last])
            own = order[lo:hi]
            if len(own):
                mark[own] = sent.value.probe(unique[own], kind)
        if len(filters) > 1:
            _forget(sent)
    return [mark[at] for _, at, _, _, _, mark in found]


def _forget(sent) -> None:
    """Let go of a broadcast's value in this worker; the next look reads it from the executor's disk."""
    sent.__dict__.pop("_value", None)


def _scored(numbered: DataFrame, filters, kind: str) -> DataFrame:
    """batch, place, doc_id, n_tokens, score of every row, in one pass over the texts."""
    limit = HELD_BYTES if len(filters) > 1 else 1

    def run(batches):
        for held in _groups(_chunks(batches), limit):
            parts = [tokens(texts) for _, _, _, texts in held]
            edges = np.concatenate([[0], np.cumsum([len(t) for t, _ in parts])])
            words = np.concatenate([t for t, _ in parts])
            spans = np.concatenate([pairs(t, offsets) for t, offsets in parts])
            word_marks, pair_marks = _look_up([(words, _WORD), (spans, _PAIR)], filters)
            model = filters[-1][1].value
            for (number, place, rows, texts), (_, offsets), a, b in zip(held, parts, edges, edges[1:]):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(texts), number)), pa.array(place.astype(np.int32)), rows.column(0), pa.array(np.diff(offsets)),
                        pa.array(model.likelihood(word_marks[a:b], pair_marks[a:b], offsets)),
                    ],
                    names=["batch", "place", "doc_id", "n_tokens", "score"],
                )

    return numbered.mapInArrow(lean(run), f"batch long, place int, doc_id {kind}, n_tokens long, score double")


def _sum_up(key, group):
    """A batch's texts with the shards' partial sums added up."""
    number = key[0].as_py()
    parts = []
    for data in group.column("data").to_pylist():
        n = int(np.frombuffer(data, np.int64, 1)[0])
        parts.append((np.frombuffer(data, np.float64, n, 8), np.frombuffer(data, np.uint32, n, 8 + 8 * n), np.frombuffer(data, np.uint16, n, 8 + 12 * n)))
    text = np.concatenate([p[2] for p in parts])
    total = np.bincount(text, weights=np.concatenate([p[0] for p in parts]))
    known = np.bincount(text, weights=np.concatenate([p[1] for p in parts]))
    n = len(total)
    return pa.table({"batch": pa.array(np.full(n, number)), "place": pa.array(np.arange(n, dtype=np.int32)), "logs": pa.array(total), "n_known": pa.array(known.astype(np.int64))})


def score(docs: DataFrame, train) -> DataFrame:
    """Every text's doc_id, n_tokens, n_known, train_tokens, base_score and score; ``train`` (a
    boolean column expression) says which rows are learnt from. NULL texts: as empty ones, which
    have one token, the end.

    ``docs`` is read once. Its rows are numbered as they are written to the shared folder, and all
    passes use the written numbers: how a later scan is split does not matter."""
    spark = docs.sparkSession
    ship_code(spark)
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(train, F.lit(False)).alias("train"), "text"), "numbered-texts")
    n_shards = shards(spark, 1, _PACKED * text_bytes_of(rows))
    answers = stage(_count(rows, n_shards), "ngram-counts")
    release(spark)
    texts = rows.filter("train").count()
    parts, fetch = _segments(answers, n_shards, texts)
    filters = []
    for part in parts:  # the driver holds one segment at a time
        counts = fetch(*part)
        filters.append((part, spark.sparkContext.broadcast(counts)))
    release(spark)
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = _scored(rows.select("row", "doc_id", "text"), filters, kind)
    exact = answers.filter("kind = 0").select("batch", "data").groupBy("batch").applyInArrow(_sum_up, "batch long, place int, logs double, n_known long")
    space = float(math.log10(counts.tokens + counts.words + 1))
    return few_files(scored.join(exact, ["batch", "place"], "left")).select(
        "doc_id", "n_tokens", F.coalesce("n_known", F.lit(0)).alias("n_known"), F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.coalesce("logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(space)).alias("base_score"), "score",
    )


def op4_lm_score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    NULL and empty texts have one token, the end. A NULL id is in no fold: its row is learnt from.
    Repeated rows count as often as they occur; rows that share an id keep their own scores. Other
    columns are not read; no rows give no rows."""
    out = score(docs, ~in_fold(7, 2))
    return out.withColumn("held_out", in_fold(7, 2)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
