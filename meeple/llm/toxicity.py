"""Toxicity by a small convolutional text classifier trained in numpy (operator 5).

A word's vector is the sum of three hashed embeddings: the word and its first four and five
letters (so that inflected forms share weight). Filters of several widths run over the words,
each keeps its maximum over the whole text, and a linear layer gives a logit. Embeddings start
from how much more often a bucket occurs in toxic texts than chance would have it; training by
gradient steps goes on from there.

Every labelled text outside the held-out fold takes part: a fifth of them in the thresholds, all
others in the counts and in the training. Those are dealt to shards of about ``SHARD_BYTES`` by a
hash. Each shard's gradient steps start from the same model and go through all of its texts, and
the shards' models are averaged, ``ROUNDS`` times. With one shard that is plain training.

Thresholds are calibrated by language on the texts that training does not see. The
language is guessed from the text's function words (never read from a column), and scores are
shifted so that each language's threshold lies at ``DECISION``.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meeple.llm.common import (
    SpanHasher, code_points, fold, in_fold, lean, letters, lowered, map_slices, mix64, release, row_ids, runs, stage, unstage,
)

BUCKETS = 1 << 15
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Bytes of words (six each) that a shard holds on average; a task trains on twice as many at a time.
SHARD_BYTES = 32 << 20
#: Times that the shards' models are averaged, where there are several; each time a shard goes through all of its texts.
ROUNDS = 2
#: Least training steps of a shard; a large one takes as many as its texts need. Every batch is half toxic.
STEPS = 600
BATCH = 32
RATE = 0.02
#: One labelled text of so many is kept from the training, for the thresholds.
APART = 5
#: Logits are counted in cells of 1 / CELLS, up to MAX_LOGIT on either side.
CELLS = 1024
MAX_LOGIT = 32
#: A text is toxic from this score on.
DECISION = 0.3

# Frequent function words, by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for on was be with as by this are at from he she they not",
    "fr": "le la les des et est un une dans que qui pour par sur au du pas ce ne vous nous",
    "de": "der die das und ist von mit den dem zu nicht ein eine auf auch sich des wird",
    "es": "el los las y es una por con para del se su al lo como más pero sus",
    "it": "il gli che di non una sono per con del della nel alla anche più",
    "pt": "o os as um uma não por com para do da no na em dos mais seu",
    "nl": "het een van en op dat niet zijn te met voor aan ook maar",
}
LANGUAGES = [*FUNCTION_WORDS, "other"]
_SALTS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)


def token_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(words x 3) hashed buckets of every word (a run of letters, lower-cased) and each text's
    first word (len+1 offsets)."""
    cp, offsets = code_points([t + "\n" for t in texts])
    if not len(cp):
        return np.zeros((0, 3), np.uint16), np.zeros(len(texts) + 1, np.int64)
    starts, ends = runs(letters(cp))
    hasher = SpanHasher(mix64(lowered(cp).astype(np.uint64)))
    columns = []
    for salt, length in zip(_SALTS, (None, 4, 5)):
        stop = ends if length is None else np.minimum(ends, starts + length)
        h = mix64(hasher(starts, stop) ^ np.uint64(salt))
        columns.append((h >> np.uint64(49)).astype(np.uint16))
    return np.stack(columns, axis=1), np.searchsorted(starts, offsets)


def _padded(tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text followed by max(WIDTHS) rows of the empty bucket, and each one's first row. Windows
    that start at a text's words or at its first empty row span no other text, and an empty text has
    one too; those at later empty rows reach into the next text and don't count."""
    pad = max(WIDTHS)
    n = np.diff(offsets)
    starts = offsets[:-1] + pad * np.arange(len(n))
    out = np.full((int(offsets[-1]) + pad * len(n), 3), BUCKETS, dtype=np.int32)
    at = np.arange(int(offsets[-1])) + pad * np.repeat(np.arange(len(n)), n)
    out[at] = tokens
    return out, starts


@dataclass
class ToxicityModel:
    embedding: np.ndarray  # (BUCKETS + 1) x DIM; the last row stays zero
    kernels: list[np.ndarray]  # per width: width x DIM x FILTERS
    bias: np.ndarray  # filters of all widths
    weights: np.ndarray
    intercept: float
    thresholds: np.ndarray  # logit threshold per language
    language_of: np.ndarray  # word bucket -> language or -1

    def convolve(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word vectors, and (positions x filters) responses of windows starting at each."""
        x = self.embedding[tokens[:, 0]] + self.embedding[tokens[:, 1]] + self.embedding[tokens[:, 2]]
        y = np.zeros((len(x), FILTERS * len(WIDTHS)), dtype=np.float32)
        for i, (w, kernel) in enumerate(zip(WIDTHS, self.kernels)):
            out = y[:, i * FILTERS : (i + 1) * FILTERS]
            for j in range(w):
                out[: len(x) - j] += x[j:] @ kernel[j]
        return x, y

    def logits(self, tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if len(offsets) < 2:
            return np.zeros(0)
        padded, starts = _padded(tokens, offsets)
        _, y = self.convolve(padded)
        edges = np.stack([starts, starts + np.diff(offsets) + 1], axis=1).ravel()
        top = np.maximum.reduceat(y, edges, axis=0)[::2]
        return np.maximum(top + self.bias, 0) @ self.weights + self.intercept

    def languages(self, tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Language (index into LANGUAGES) by function words; "other" without any."""
        n = len(offsets) - 1
        kind = self.language_of[tokens[:, 0]]
        doc = np.repeat(np.arange(n), np.diff(offsets))
        hit = kind >= 0
        votes = np.bincount(doc[hit] * len(LANGUAGES) + kind[hit], minlength=n * len(LANGUAGES)).reshape(n, -1)
        votes[:, -1] = 0
        return np.where(votes.max(axis=1) > 0, votes.argmax(axis=1), len(LANGUAGES) - 1)

    def score(self, texts: list[str]) -> np.ndarray:
        tokens, offsets = token_buckets(texts)
        z = self.logits(tokens, offsets) - self.thresholds[self.languages(tokens, offsets)]
        return 1 / (1 + np.exp(-np.clip(z + np.log(DECISION / (1 - DECISION)), -500, 500)))


def _language_table() -> np.ndarray:
    table = np.full(BUCKETS + 1, -1, dtype=np.int8)
    for k, words in enumerate(FUNCTION_WORDS.values()):
        buckets, _ = token_buckets(words.split())
        table[buckets[:, 0]] = k
    return table


def _untrained(rng: np.random.Generator) -> ToxicityModel:
    embedding = rng.normal(0, 0.1, size=(BUCKETS + 1, DIM)).astype(np.float32)
    embedding[BUCKETS] = 0
    kernels = [rng.normal(0, 0.3, size=(w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    n = FILTERS * len(WIDTHS)
    weights = rng.normal(0, 0.3, size=n).astype(np.float32)
    return ToxicityModel(
        embedding, kernels, np.zeros(n, np.float32), weights, -2.0, np.zeros(len(LANGUAGES)), _language_table()
    )


def _pieces(model: ToxicityModel) -> list[np.ndarray]:
    """The trained arrays as rows of DIM values that share their memory; the embedding comes first."""
    return [model.embedding, *(k.reshape(-1, DIM) for k in model.kernels), model.bias.reshape(-1, DIM), model.weights.reshape(-1, DIM)]


class _AdaGrad:
    def __init__(self, rate: float):
        self.rate, self.sums = rate, {}
        self.moves = np.zeros(BUCKETS + 1, dtype=np.int64)  # steps that changed a row of the embedding

    def step(self, name: str, value: np.ndarray, grad: np.ndarray) -> None:
        g = self.sums.setdefault(name, np.full_like(value, 1e-3))
        g += grad * grad
        value -= self.rate * grad / np.sqrt(g)

    def sparse(self, name: str, value: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
        rows, at = np.unique(rows, return_inverse=True)
        total = np.zeros((len(rows), value.shape[1]), dtype=np.float32)
        np.add.at(total, at, grad)
        self.moves[rows] += total.any(axis=1)
        g = self.sums.setdefault(name, np.full_like(value, 1e-3))
        g[rows] += total * total
        value[rows] -= self.rate * total / np.sqrt(g[rows])


def train(tokens: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, seed: int = 11) -> ToxicityModel:
    """Fit on (words x 3) bucket arrays with 0/1 labels and row weights, as one shard; the model's
    thresholds are calibrated on every fifth row, which the fit leaves out."""
    model = _untrained(np.random.default_rng(seed))
    n = len(tokens)
    if not n or labels.min() == labels.max():
        model.weights[:] = 0
        return model
    calibration = np.arange(n) % APART == APART - 1
    own, y = [t for t, c in zip(tokens, calibration) if not c], labels[~calibration]
    _informed_start(model, _document_counts(own, y), np.array([(y == 0).sum(), (y == 1).sum()]))
    _passes(model, _AdaGrad(RATE), own, y, np.random.default_rng([seed, 0]))
    _calibrate(model, tokens, labels, weights, calibration)
    return model


def _document_counts(tokens: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """(2 x buckets) clean and toxic texts that a bucket occurs in."""
    seen = np.zeros((2, BUCKETS + 1), dtype=np.int64)
    for t, y in zip(tokens, labels):
        seen[int(y), np.unique(t)] += 1
    return seen


def _informed_start(model: ToxicityModel, seen: np.ndarray, texts: np.ndarray) -> None:
    """First embedding dimension: the log-likelihood ratio of a bucket's toxic and clean texts
    against equal rates, where toxic ones are more frequent; the first filter reads it. ``texts``:
    how many are clean and toxic."""
    share = texts[1] / max(1, texts.sum())
    both = seen.sum(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = sum(
            np.where(seen[k] > 0, seen[k] * np.log(seen[k] / (both * rate)), 0.0) for k, rate in ((1, share), (0, 1 - share))
        )
    more = (seen[1] > both * share) & (both > 0)
    model.embedding[:, 0] = np.where(more, np.minimum(gain, 30.0) / 10.0, 0.0)
    model.embedding[BUCKETS] = 0
    model.kernels[0][0, :, 0] = 0
    model.kernels[0][0, 0, 0] = 1.0
    model.weights[0] = 1.0


def _passes(model: ToxicityModel, opt: _AdaGrad, tokens: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator) -> None:
    """Gradient steps on shuffled passes through the texts of either label, as many as it takes to
    use every text and STEPS at least."""
    half = BATCH // 2
    kinds = [own for k in (0, 1) if len(own := np.flatnonzero(labels == k))]
    steps = max([STEPS, *(-(-len(own) // half) for own in kinds)])
    orders = [_shuffled(own, steps * half, rng) for own in kinds]
    for a in range(0, steps * half, half):
        rows = np.concatenate([order[a : a + half] for order in orders])
        _step(model, opt, [tokens[i] for i in rows], labels[rows])


def _shuffled(rows: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """``n`` of the rows: all of them in random order, again and again."""
    return np.concatenate([rng.permutation(rows) for _ in range(-(-n // len(rows)))])[:n]


def _step(model: ToxicityModel, opt: _AdaGrad, tokens: list[np.ndarray], labels: np.ndarray) -> None:
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
    padded, starts = _padded(np.concatenate(tokens), offsets)
    x, y = model.convolve(padded)
    ends = starts + np.diff(offsets) + 1
    best = np.stack([a + y[a:b].argmax(axis=0) for a, b in zip(starts, ends)])  # texts x filters
    top = np.take_along_axis(y, best, axis=0)
    hidden = np.maximum(top + model.bias, 0)
    z = hidden @ model.weights + model.intercept
    slope = ((1 / (1 + np.exp(-z)) - labels) / len(labels)).astype(np.float32)
    grad = slope[:, None] * model.weights[None, :] * (hidden > 0)  # texts x filters
    model.intercept -= 0.1 * float(slope.sum())
    opt.step("weights", model.weights, hidden.T @ slope + 1e-4 * model.weights)
    opt.step("bias", model.bias, grad.sum(axis=0))
    changed, change = [], []
    for i, (w, kernel) in enumerate(zip(WIDTHS, model.kernels)):
        cols = slice(i * FILTERS, (i + 1) * FILTERS)
        g, at = grad[:, cols], best[:, cols]
        dk = np.zeros_like(kernel)
        for j in range(w):
            inside = np.minimum(at + j, len(x) - 1)
            dk[j] = np.einsum("tfd,tf->df", x[inside], g)
            dx = g[:, :, None] * kernel[j].T[None, :, :]
            rows = padded[inside].reshape(-1, 3)
            for c in range(3):
                changed.append(rows[:, c])
                change.append(dx.reshape(-1, DIM))
        opt.step(f"kernel{i}", kernel, dk + 1e-4 * kernel)
    opt.sparse("embedding", model.embedding, np.concatenate(changed), np.concatenate(change))
    model.embedding[BUCKETS] = 0


def _logits(model: ToxicityModel, tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Logits and languages, a few texts at a time."""
    z, lang = [np.zeros(0)], [np.zeros(0, np.int64)]
    for b in range(0, len(tokens), BATCH):
        own = tokens[b : b + BATCH]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in own])])
        joined = np.concatenate(own)
        z.append(model.logits(joined, offsets))
        lang.append(model.languages(joined, offsets))
    return np.concatenate(z), np.concatenate(lang)


def _calibrate(model, tokens, labels, weights, rows) -> None:
    """Thresholds from the calibration rows."""
    at = np.flatnonzero(rows)
    z, lang = _logits(model, [tokens[i] for i in at])
    _set_thresholds(model, z, lang, labels[at], weights[at], labels[at] == 1)


def _set_thresholds(model, z, lang, y, w, toxic) -> None:
    """Per language, the logit threshold of best F1; that of all texts where a language has fewer
    than 10 toxic ones. ``y``: toxic share at a logit, ``w``: weight, ``toxic``: number of toxic texts."""
    if not len(z):
        return
    model.thresholds[:] = _best_threshold(z, y, w)
    for k in range(len(LANGUAGES)):
        own = lang == k
        if toxic[own].sum() >= 10:
            model.thresholds[k] = _best_threshold(z[own], y[own], w[own])


def _best_threshold(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    if not len(z):
        return 0.0
    order = np.argsort(-z)
    z, y, w = z[order], y[order], w[order]
    hits, false = np.cumsum(w * y), np.cumsum(w * (1 - y))
    f1 = 2 * hits / (hits + false + (w * y).sum() + 1e-9)
    f1[:-1][z[1:] == z[:-1]] = -1  # equal logits stay on one side
    i = int(f1.argmax())
    return float((z[i] + z[i + 1]) / 2) if i + 1 < len(z) else float(z[i] - 1e-3)


# --- jobs -------------------------------------------------------------------------------------


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2) -> ToxicityModel:
    """Learn from all labelled texts outside the held-out fold. A document with several labels is
    toxic if one says so. No labels, or one class only: a constant score. The driver gets counts of
    buckets, averaged parameters and counts of logits, whose numbers don't depend on the texts'."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & (fold(modulus) != held_out))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(F.col("toxic").isin(0, 1))
    )
    packed = _pack(docs.filter(fold(modulus) != held_out), known)
    release(docs.sparkSession)  # the join's shuffle
    apart = F.pmod("place", F.lit(APART)) == APART - 1
    size = {
        (r["apart"], r["toxic"]): (r["texts"], r["bytes"])
        for r in packed.groupBy(apart.alias("apart"), "toxic")
        .agg(F.count("*").alias("texts"), F.sum(F.length("tokens")).alias("bytes")).collect()
    }
    model = _untrained(np.random.default_rng(11))
    if {k for _, k in size} == {0, 1}:
        own = packed.filter(~apart)
        _informed_start(model, _count_documents(own), np.array([size.get((False, k), (0, 0))[0] for k in (0, 1)]))
        n = max(1, -(-sum(size.get((False, k), (0, 0))[1] for k in (0, 1)) // SHARD_BYTES))
        for number in range(ROUNDS if n > 1 else 1):
            _train_shards(own, model, n, number)
            release(docs.sparkSession)  # its shuffle
        _count_logits(packed.filter(apart), model)
    else:
        model.weights[:] = 0
    unstage(packed)
    return model


def _pack(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Label, a hash of id and text, and word buckets of the labelled texts, written. Labels grow with
    the texts, so that neither side is broadcast."""
    rows = docs.select("doc_id", "text").join(known.hint("merge"), "doc_id").select(
        F.col("toxic").cast("int").alias("toxic"), F.xxhash64(F.lit("toxic"), "doc_id", "text").alias("place"), "text"
    )

    def pack(texts, batch):
        tokens, offsets = token_buckets(texts)
        return {
            "toxic": row_ids(batch, "toxic"), "place": row_ids(batch, "place"),
            "tokens": [tokens[a:b].tobytes() for a, b in zip(offsets, offsets[1:])],
        }

    return stage(map_slices(rows, pack, "toxic int, place long, tokens binary"), "toxicity-words")


def _texts(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
    """Word buckets and labels of packed rows."""
    return [np.frombuffer(t, np.uint16).reshape(-1, 3) for t in row_ids(batch, "tokens").to_pylist()], row_ids(batch, "toxic").to_numpy()


def _count_documents(packed: DataFrame) -> np.ndarray:
    """:func:`_document_counts` of all rows."""

    def run(batches):
        seen = np.zeros((2, BUCKETS + 1), dtype=np.int64)
        for batch in batches:
            seen += _document_counts(*_texts(batch))
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "clean": seen[0, at], "toxic": seen[1, at]})

    total = packed.select("toxic", "tokens").mapInArrow(lean(run), "bucket int, clean long, toxic long")
    seen = np.zeros((2, BUCKETS + 1), dtype=np.int64)
    for r in total.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).collect():
        seen[:, r["bucket"]] = r["clean"], r["toxic"]
    return seen


_VALUES = [f"v{i}" for i in range(DIM)]


def _train_shards(packed: DataFrame, model: ToxicityModel, n: int, number: int) -> None:
    """Train ``model`` on ``n`` shards apart and put the average in its place: a row of the embedding
    counts as often as its shard moved it, all else as often as the shard has texts. Sums are of
    whole numbers (2^-24), so that their order makes no difference."""
    sent = packed.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for shard, chunks in _shards(batches):
            own, opt, texts = copy.deepcopy(sent.value), _AdaGrad(RATE), 0
            rng = np.random.default_rng([11, number, shard])
            for tokens, labels in chunks:
                _passes(own, opt, tokens, labels, rng)
                texts += len(tokens)
            values = np.concatenate([*_pieces(own), np.full((1, DIM), own.intercept)])
            weight = np.concatenate([opt.moves, np.full(len(values) - len(opt.moves), texts)])
            at = np.flatnonzero(weight)
            total = np.rint(values[at].astype(np.float64) * (1 << 24)).astype(np.int64) * weight[at, None]
            yield pa.RecordBatch.from_pydict(
                {"place": pa.array(at, pa.int32()), "weight": weight[at]} | {v: total[:, i] for i, v in enumerate(_VALUES)}
            )

    dealt = packed.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "place"), F.lit(n)).cast("int"))
    trained = dealt.repartitionById(n, "shard").sortWithinPartitions("shard", "place").mapInArrow(
        lean(run), "place int, weight long, " + ", ".join(f"{v} long" for v in _VALUES)
    )
    values = np.concatenate([*_pieces(model), np.full((1, DIM), model.intercept)])
    for r in trained.groupBy("place").agg(*(F.sum(c).alias(c) for c in ("weight", *_VALUES))).collect():
        values[r["place"]] = [r[v] / r["weight"] / (1 << 24) for v in _VALUES]
    first = 0
    for piece in _pieces(model):
        piece[:] = values[first : first + len(piece)]
        first += len(piece)
    model.intercept = float(values[-1, 0])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[list[np.ndarray], np.ndarray]]]]:
    """(shard, its texts and labels) of packed rows in the order of shards; a shard comes in chunks
    of up to twice SHARD_BYTES, or one text."""
    pieces = (
        (int(shard), t, y)
        for batch in batches
        for shard, t, y in zip(row_ids(batch, "shard").to_numpy(), *_texts(batch))
    )
    held = next(pieces, None)

    def chunks(shard):
        nonlocal held
        tokens, labels, size = [], [], 0
        while held and held[0] == shard:
            if tokens and size + held[1].nbytes > 2 * SHARD_BYTES:
                yield tokens, np.array(labels, np.float32)
                tokens, labels, size = [], [], 0
            tokens.append(held[1])
            labels.append(held[2])
            size += held[1].nbytes
            held = next(pieces, None)
        yield tokens, np.array(labels, np.float32)

    while held:
        yield held[0], chunks(held[0])


def _count_logits(packed: DataFrame, model: ToxicityModel) -> None:
    """Thresholds from all rows: their logits counted by language and cell."""
    sent = packed.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            tokens, toxic = _texts(batch)
            z, lang = _logits(sent.value, tokens)
            cell = np.floor(np.clip(z, -MAX_LOGIT, MAX_LOGIT) * CELLS).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {"language": pa.array(lang, pa.int32()), "cell": cell, "toxic": pa.array(toxic, pa.int32())}
            )

    cells = packed.select("toxic", "tokens").mapInArrow(lean(run), "language int, cell int, toxic int")
    got = cells.groupBy("language", "cell").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("texts")).collect()
    got.sort()
    lang, cell, toxic, texts = np.array([tuple(r) for r in got], dtype=np.int64).reshape(-1, 4).T
    z = (cell + 0.5) / CELLS
    _set_thresholds(model, z, lang, toxic / np.maximum(texts, 1), texts, toxic)


def classify(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row plus score and predicted. NULL text: as an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts, batch):
        score = sent.value.score(texts)
        return {c: row_ids(batch, c) for c in keep} | {"score": score, "predicted": (score >= DECISION).astype(np.int32)}

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    columns = dict.fromkeys([*keep, "text"])
    return map_slices(docs.select(*columns), run, f"{schema}, score double, predicted int")


def op5_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    NULL texts are scored as empty ones, which no window of words speaks against. Long texts are
    scored whole. Repeated rows give equal scores; a NULL id is not held out. Without labels of
    both kinds the score is a constant. Other columns are not read; no rows give no rows."""
    model = fit(docs, labels)
    return classify(docs.withColumn("held_out", in_fold(4, 2)), model, ["doc_id", "held_out"])
