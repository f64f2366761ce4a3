"""Byte-level BPE encoding and decoding without a regex (operator 9).

Pre-tokenisation is vectorised: every code point gets a symbol class, every class is a
transition function of a seven-state automaton, and an associative scan composes those
functions to give the state before every code point. Token starts then follow from state and
class alone. The slices go through pair merging by rank, behind a bounded cache; token byte
offsets are kept, and decoding gathers the vocabulary's bytes by id.

The splits are those of the usual byte-level pattern (contractions, optional blank + letters,
optional blank + digits, optional blank + other, white space).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.llm.common import BYTE_CODES, SpanHasher, code_points, map_slices, row_ids, ship_code

# --- the automaton ----------------------------------------------------------------------------

# symbol classes
BLANK, SPACE, LETTER, NUMBER, OTHER, SHORT, LONG, END = range(8)
# states: what the code points so far leave for the next one
(
    FRESH,  # nothing to continue: a token starts here
    AFTER_BLANK,  # one U+0020 before: it belongs to the token that starts now
    IN_LETTERS,
    IN_NUMBERS,
    IN_OTHER,
    ONE_LEFT,  # inside a contraction, one letter to go
    TWO_LEFT,
) = range(7)

# The contractions of the pattern, by number of letters after the apostrophe.
SHORT_CONTRACTIONS = "stmd"
LONG_CONTRACTIONS = ("re", "ve", "ll")
# Unicode white space.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _apostrophe(letters_left: int) -> list[int]:
    return [IN_OTHER if s in (AFTER_BLANK, IN_OTHER) else letters_left for s in range(7)]


#: For each class, the state after it for each state before it.
TRANSITIONS = {
    BLANK: [AFTER_BLANK] * 7,
    SPACE: [FRESH] * 7,
    LETTER: [ONE_LEFT if s == TWO_LEFT else FRESH if s == ONE_LEFT else IN_LETTERS for s in range(7)],
    NUMBER: [IN_NUMBERS] * 7,
    OTHER: [IN_OTHER] * 7,
    SHORT: _apostrophe(ONE_LEFT),
    LONG: _apostrophe(TWO_LEFT),
    END: [FRESH] * 7,
}


def _closure() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that compositions of the transitions can give: their values (functions x
    states), the composition table (first, then second), and each class's function number."""
    identity = tuple(range(7))
    found = {identity: 0}
    for f in TRANSITIONS.values():
        found.setdefault(tuple(f), len(found))
    grown = True
    while grown:
        grown = False
        for f, g in product(list(found), repeat=2):
            h = tuple(g[s] for s in f)
            if h not in found:
                found[h] = len(found)
                grown = True
    funcs = list(found)
    compose = np.array([[found[tuple(g[s] for s in f)] for g in funcs] for f in funcs], dtype=np.uint8)
    return np.array(funcs, dtype=np.uint8), compose, np.array([found[tuple(TRANSITIONS[c])] for c in range(8)], np.uint8)


FUNCTIONS, COMPOSE, OF_CLASS = _closure()
_COMPOSE_FLAT = COMPOSE.ravel()
_M = np.uint16(len(FUNCTIONS))
_BLOCK = 128


def scan(functions: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of function numbers: blocks side by side, then block totals."""
    n = len(functions)
    if n <= _BLOCK:
        out = functions.copy()
        for i in range(1, n):
            out[i] = COMPOSE[out[i - 1], out[i]]
        return out
    blocks = -(-n // _BLOCK)
    grid = np.zeros(blocks * _BLOCK, dtype=np.uint8)  # 0: the identity
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(blocks, _BLOCK).T)
    for j in range(1, _BLOCK):
        grid[j] = _COMPOSE_FLAT[grid[j - 1] * _M + grid[j]]
    totals = scan(grid[-1])
    before = np.concatenate([np.zeros(1, np.uint8), totals[:-1]])
    grid = _COMPOSE_FLAT[(before * _M)[None, :] + grid]
    return grid.T.ravel()[:n]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major == "L":
            kinds[c] = LETTER
        elif major == "N":
            kinds[c] = NUMBER
    kinds[WHITE_SPACE] = SPACE
    kinds[32] = BLANK
    return kinds


def token_starts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts joined with an end mark after each; the code point offsets at which
    pre-tokens (and end marks) start; and each text's offset (len+1 entries)."""
    joined = "\0".join(texts) + "\0"
    cp, _ = code_points([joined])
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    kind = _classes()[cp]
    ends = offsets[1:] - 1
    kind[ends] = END
    # apostrophes that could start a contraction, by the letters that follow
    for at in (np.flatnonzero(cp == 39),):
        one = np.take(cp, at + 1, mode="clip")
        two = np.take(cp, at + 2, mode="clip")
        kind[at[np.isin(one, [ord(c) for c in SHORT_CONTRACTIONS])]] = SHORT
        is_long = np.zeros(len(at), dtype=bool)
        for a, b in LONG_CONTRACTIONS:
            is_long |= (one == ord(a)) & (two == ord(b))
        kind[at[is_long]] = LONG
        kind[ends] = END
    after = FUNCTIONS[scan(OF_CLASS[kind]), FRESH]
    state = np.empty_like(after)
    state[0] = FRESH
    state[1:] = after[:-1]

    letter, number = kind == LETTER, kind == NUMBER
    apostrophe = (kind == SHORT) | (kind == LONG)
    white = kind <= SPACE
    fresh = state == FRESH
    in_word, in_number, in_other = state == IN_LETTERS, state == IN_NUMBERS, state == IN_OTHER
    starts = (
        (letter & (fresh | in_number | in_other))
        | (number & (fresh | in_word | in_other))
        | (((kind == OTHER) | apostrophe) & (fresh | in_word | in_number))
        | (kind == END)
    )
    # white space: a token starts with each run, and with its last character unless the text ends
    before = np.concatenate([[False], white[:-1]])
    behind = np.concatenate([kind[1:], [END]])
    starts |= white & (~before | ((behind > SPACE) & (behind != END)))
    # a single U+0020 before a token is its first character: the token itself starts no new one
    return joined, np.flatnonzero(starts), offsets


# --- merging ------------------------------------------------------------------------------------

_CACHE_ENTRIES = 200_000
_HEAP_FROM = 49  # longer pre-tokens are merged one by one, with a heap
_NO_RANK = np.int32(2**31 - 1)


class PairTable:
    """(left id, right id) -> id of their concatenation, as an open-addressing hash table."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, value = [], [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    value.append(rank)
        keys = self._key(np.array(left, np.int64), np.array(right, np.int64))
        self.bits = max(10, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, _NO_RANK, dtype=np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot] == -1
            first = np.unique(slot[free], return_index=True)[1]
            placed = np.flatnonzero(free)[first]
            self.keys[slot[placed]] = keys[todo[placed]]
            self.values[slot[placed]] = np.array(value, np.int32)[todo[placed]]
            left_over = np.ones(len(todo), bool)
            left_over[placed] = False
            todo, slot = todo[left_over], (slot[left_over] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.astype(np.int64) << np.int64(32) | b.astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merged id for each pair, or ``_NO_RANK``."""
        keys = self._key(a, b)
        slot = self._slot(keys)
        out = np.full(len(keys), _NO_RANK, dtype=np.int32)
        todo = np.arange(len(keys))
        while len(todo):
            have = self.keys[slot]
            hit = have == keys[todo]
            out[todo[hit]] = self.values[slot[hit]]
            again = ~hit & (have != -1)
            todo, slot = todo[again], (slot[again] + 1) & ((1 << self.bits) - 1)
        return out


class PieceCache:
    """Ids of byte strings, in flat arrays ordered by the strings' 64-bit hashes. A hit is checked
    byte by byte."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        # per entry: first byte, number of bytes, first id, number of ids
        self.table = np.zeros((4, 0), np.int64)
        self.raw, self.ids = np.zeros(0, np.uint8), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Entry of each string, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = np.flatnonzero((self.keys[at] == keys) & (self.table[1, at] == sizes))
        same = equal_spans(self.raw, self.table[0, at[hit]], data, starts[hit], sizes[hit])
        out = np.full(len(keys), -1, dtype=np.int64)
        out[hit[same]] = at[hit[same]]
        return out

    def add(self, keys, data, starts, sizes, ids: np.ndarray, counts: np.ndarray) -> None:
        """Enter strings with their ids, which lie one after another."""
        order = np.argsort(keys, kind="stable")
        rows = np.stack([
            len(self.raw) + np.cumsum(sizes) - sizes, sizes, len(self.ids) + np.cumsum(counts) - counts, counts
        ])
        place = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, place, keys[order])
        self.table = np.insert(self.table, place, rows[:, order], axis=1)
        self.raw = np.concatenate([self.raw, data[ragged(starts, sizes)]])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def ids_of(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries' ids, one after another, and their numbers."""
        _, _, at, n = self.table[:, entries]
        return self.ids[ragged(at, n)], n


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), then those of starts[1], and so on."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def equal_spans(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mask: are a[a_start : a_start + size] and b[b_start : b_start + size] the same?"""
    same = np.ones(len(sizes), dtype=bool)
    index = ragged(b_starts, sizes)
    wrong = np.flatnonzero(a[index + np.repeat(a_starts - b_starts, sizes)] != b[index])
    if len(wrong):
        same[np.searchsorted(np.cumsum(sizes), wrong, side="right")] = False
    return same


def _flat(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings one after another, and len+1 offsets."""
    offsets = np.zeros(len(strings) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in strings], out=offsets[1:])
    return np.frombuffer(b"".join(strings), dtype=np.uint8), offsets


class Codec:
    """Ranks of byte strings. Encodes a slice of texts at once: equal pre-tokens are looked up or
    merged once, in numpy, behind a bounded two-generation cache; their ids are then gathered."""

    def __init__(self, rank_file: bytes, cache_entries: int = _CACHE_ENTRIES):
        self.ranks = {
            base64.b64decode(token): int(rank) for token, rank in (line.split() for line in rank_file.splitlines() if line)
        }
        size = max(self.ranks.values()) + 1
        self.bytes_of = [b""] * size
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.raw, self.raw_at = _flat(self.bytes_of)
        self.digits, self.digits_at = _flat([b"%d," % i for i in range(size)])
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.pairs = PairTable(self.ranks)
        self.cache_entries = cache_entries
        self.known = PieceCache()  # the vocabulary itself: such a pre-token is one token
        data, offsets = _flat(list(self.ranks))
        keys = SpanHasher(BYTE_CODES[data])(offsets[:-1], offsets[1:])
        ranks = np.array(list(self.ranks.values()))
        self.known.add(keys, data, offsets[:-1], np.diff(offsets), ranks, np.ones(len(ranks), np.int64))
        self._young, self._old = PieceCache(), PieceCache()

    def _merge_many(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of short byte strings, all at once: in every round each string merges its pair of
        least rank (leftmost first). Parts are linked by position, so nothing moves."""
        n, width = len(starts), int(sizes.max())
        column = np.arange(width)
        grid = np.take(data, starts[:, None] + column, mode="clip")
        length = sizes
        ids = self.single[grid]
        alive = column[None, :] < length[:, None]
        stop = np.broadcast_to(column + 1, (n, width)).astype(np.int64)  # start of the next part
        prev = np.broadcast_to(column - 1, (n, width)).astype(np.int64)
        rank = np.full((n, width), _NO_RANK, dtype=np.int32)
        rank[:, :-1] = self.pairs.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        rank[column[None, :] >= length[:, None] - 1] = _NO_RANK
        rows = np.arange(n)
        while len(rows):
            at = rank[rows].argmin(axis=1)
            least = rank[rows, at]
            go = least != _NO_RANK
            rows, at, least = rows[go], at[go], least[go]
            if not len(rows):
                break
            gone = stop[rows, at]
            after = stop[rows, gone]
            ids[rows, at] = least
            alive[rows, gone] = False
            rank[rows, gone] = _NO_RANK
            stop[rows, at] = after
            more = after < length[rows]
            fresh = np.full(len(rows), _NO_RANK, dtype=np.int32)
            fresh[more] = self.pairs.ranks(least[more], ids[rows[more], after[more]])
            rank[rows, at] = fresh
            prev[rows[more], after[more]] = at[more]
            left = prev[rows, at]
            has = left >= 0
            rank[rows[has], left[has]] = self.pairs.ranks(ids[rows[has], left[has]], least[has])
        return ids[alive], alive.sum(axis=1)

    def _merge_long(self, raw: bytes) -> tuple[int, ...]:
        """The same order of merges with a heap and links, for very long pre-tokens."""
        n, get = len(raw), self.ranks.get
        stop = list(range(1, n + 1))  # end of the part that starts here
        prev = list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, e = heapq.heappop(heap)
            if not alive[i] or stop[i] >= n or stop[stop[i]] != e:
                continue
            j = stop[i]
            alive[j] = False
            stop[i] = e
            if e < n:
                prev[e] = i
                if (r := get(raw[i : stop[e]])) is not None:
                    heapq.heappush(heap, (r, i, stop[e]))
            p = prev[i]
            if p >= 0 and (r := get(raw[p:e])) is not None:
                heapq.heappush(heap, (r, p, e))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[raw[i : stop[i]]])
            i = stop[i]
        return tuple(out)

    def _merged(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different byte strings, one after another, and their numbers."""
        parts, counts = [np.zeros(0, np.int32)], np.zeros(len(starts), dtype=np.int64)
        order = np.argsort(sizes, kind="stable")  # similar widths together
        short = int(np.searchsorted(sizes[order], _HEAP_FROM))
        for i in range(0, short, 4096):
            rows = order[i : min(short, i + 4096)]
            ids, counts[rows] = self._merge_many(data, starts[rows], sizes[rows])
            parts.append(ids)
        for row in order[short:]:
            ids = self._merge_long(data[starts[row] : starts[row] + sizes[row]].tobytes())
            counts[row] = len(ids)
            parts.append(np.array(ids, dtype=np.int32))
        ids, of = np.concatenate(parts), counts[order]
        at = np.empty(len(starts), dtype=np.int64)
        at[order] = np.cumsum(of) - of
        return ids[ragged(at, counts)], counts

    def _pieces(self, keys, data, starts, sizes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pre-tokens. New short ones enter the cache; when it is full, the older
        half of it goes."""
        at = np.zeros(len(keys), dtype=np.int64)  # where their ids start in the parts below
        counts = np.zeros(len(keys), dtype=np.int64)
        parts, done = [], 0
        open_ = np.arange(len(keys))
        for cache in (self.known, self._young, self._old, None):
            if cache is None:
                rows = open_
                ids, n = self._merged(data, starts[rows], sizes[rows])
            else:
                entries = cache.find(keys[open_], data, starts[open_], sizes[open_])
                rows, open_ = open_[entries >= 0], open_[entries < 0]
                ids, n = cache.ids_of(entries[entries >= 0])
            at[rows], counts[rows] = done + np.cumsum(n) - n, n
            parts.append(ids)
            done += len(ids)
            if cache in (self._old, None):
                keep = sizes[rows] < _HEAP_FROM
                if cache is None and len(self._young) + keep.sum() > self.cache_entries:
                    self._old, self._young = self._young, PieceCache()
                self._young.add(keys[rows[keep]], data, starts[rows[keep]], sizes[rows[keep]], ids[np.repeat(keep, n)], n[keep])
        return np.concatenate(parts)[ragged(at, counts)], counts

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the first id of each (len+1 offsets)."""
        if not texts:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        joined, starts, offsets = token_starts(texts)
        data = np.frombuffer(joined.encode("utf-8"), dtype=np.uint8)
        if len(data) > len(joined):  # from code points to bytes
            byte_at = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))
            starts, offsets = byte_at[starts], byte_at[offsets]
        ends = np.append(starts[1:], len(data))
        piece = ~np.isin(starts, offsets[1:] - 1)  # the last start of every text is its end mark
        starts, ends = starts[piece], ends[piece]
        sizes = ends - starts
        keys = SpanHasher(BYTE_CODES[data])(starts, ends)
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        same = (sizes == sizes[first[which]]) if len(starts) else np.zeros(0, bool)
        like = np.flatnonzero(same)
        same[like] = equal_spans(data, starts[first[which[like]]], data, starts[like], sizes[like])
        other = np.flatnonzero(~same)  # equal hashes of different bytes: pieces of their own
        which[other] = len(first) + np.arange(len(other))
        first = np.concatenate([first, other])
        ids, counts = self._pieces(keys[first], data, starts[first], sizes[first])
        at = np.cumsum(counts) - counts
        n = counts[which]
        total = np.concatenate([[0], np.cumsum(n)])
        return ids[ragged(at[which], n)], total[np.searchsorted(starts, offsets)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of every text."""
        ids, at = self.encode_flat(texts)
        return [ids[a:b].tolist() for a, b in zip(at, at[1:])]

    def digests(self, texts: list[str]) -> tuple[np.ndarray, list[str], list[str]]:
        """Of every text: the number of ids, the digest of the decimal ids joined by commas, and
        that of the bytes which the ids decode to."""
        ids, at = self.encode_flat(texts)

        def gathered(flat, offsets, drop):
            size = offsets[ids + 1] - offsets[ids]
            ends = np.concatenate([[0], np.cumsum(size)])[at]
            raw = flat[ragged(offsets[ids], size)].tobytes()
            return [hashlib.sha256(raw[a : max(a, b - drop)]).hexdigest() for a, b in zip(ends.tolist(), ends[1:].tolist())]

        return np.diff(at), gathered(self.digits, self.digits_at, 1), gathered(self.raw, self.raw_at, 0)

    def offsets(self, ids: list[int]) -> list[int]:
        """Byte offset of each id's token in the decoded bytes, and the total length."""
        ends = np.cumsum([len(self.bytes_of[i]) for i in ids], dtype=np.int64)
        return [0, *ends.tolist()]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


_CODECS: dict[str, Codec] = {}


def _codec(rank_file: bytes) -> Codec:
    """One codec per vocabulary and Python worker, so that its cache lives across tasks."""
    key = hashlib.sha256(rank_file).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(rank_file)
    return _CODECS[key]


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _sent(spark: SparkSession, rank_path: str | None):
    """The rank file (about 1 MB, read by the driver) as a broadcast."""
    with open(rank_path or default_ranks(), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, rank_path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, ids (array<int>) and byte_offsets (array<long>, one more than ids) of every
    text. NULL and empty texts have no ids."""
    sent, kind = _sent(docs.sparkSession, rank_path), docs.schema[id_col].dataType.simpleString()

    def run(texts, rows):
        codec = _codec(sent.value)
        ids = codec.encode(texts)
        return {id_col: row_ids(rows, id_col), "ids": ids, "byte_offsets": [codec.offsets(i) for i in ids]}

    return map_slices(docs.select(id_col, "text"), run, f"`{id_col}` {kind}, ids array<int>, byte_offsets array<long>")


def decode(encoded: DataFrame, rank_path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and decoded (binary) for every row with ``ids``."""
    ship_code(encoded.sparkSession)
    sent, kind = _sent(encoded.sparkSession, rank_path), encoded.schema[id_col].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    def run(batches):
        codec = _codec(sent.value)
        for batch in batches:
            decoded = [codec.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(to_arrow_type(kind)), pa.array(decoded, pa.binary())], names=[id_col, "decoded"]
            )

    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind.simpleString()}, decoded binary")


def digests(docs: DataFrame, rank_path: str | None = None) -> DataFrame:
    """Encode every text, decode the ids again, and keep counts and digests of both."""
    sent = _sent(docs.sparkSession, rank_path)

    def run(texts, rows):
        n, ids, decoded = _codec(sent.value).digests(texts)
        return {"doc_id": row_ids(rows), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_slices(docs.select("doc_id", "text"), run, schema)


def op9_bpe(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document.

    NULL and empty texts have no tokens (digests of nothing). Very long pre-tokens are merged with
    a heap and not cached. Repeated rows give equal rows; other columns are not read; no rows give
    no rows."""
    return digests(docs.select(F.col("doc_id"), F.col("text")))
