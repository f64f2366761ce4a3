"""Text quality by a sparse rule ensemble (operator 13).

Every text becomes a row of statistics (:data:`FEATURES`): shares of character classes, word
lengths, repetition of words, pairs and lines. Small boosted trees are grown on a bounded sample
of labelled rows; every path from a root to a node is a rule, a conjunction of thresholds. A logistic
model with an L1 penalty keeps a few rules and weighs them. The rules that are left are compiled
into one Spark column expression over the statistics, so scoring is a projection.

Scores are shifted so that the threshold of best balanced accuracy, on sample rows that neither
trees nor weights have seen, lies at ``DECISION``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meeple.llm.common import SpanHasher, code_points, fold, in_fold, letters, lowered, map_slices, mix64, row_ids, runs

#: Labelled rows that the model is fitted on, for each of the two labels.
MAX_PER_LABEL = 4000
#: A text is good from this score on.
DECISION = 0.3
TREES = 30
DEPTH = 3
BINS = 32
SHRINKAGE = 0.3
#: Least sample rows on either side of a split: two, and one more for so many rows of the sample.
ROWS_PER_MIN_ROW = 400
#: L1 penalties tried, as shares of the least one that keeps no rule.
PENALTIES = (0.3, 0.1, 0.03, 0.01)
STEPS = 300

FEATURES = [
    "log_chars", "log_words", "word_length", "letter_share", "upper_share", "digit_share", "mark_share", "stops_per_word",
    "lone_mark_share", "marked_end_share", "repeat_share", "distinct_words", "top_word_share", "distinct_pairs", "log_lines",
    "words_per_line", "repeated_line_share",
]

# Marks that end a word in ordinary prose, and those that end a sentence.
USUAL_ENDS = ".,;:!?'\")]}»”’…"
STOPS = ".!?…"
_SALT = np.uint64(0x452821E638D01377)


# --- statistics -------------------------------------------------------------------------------


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often the mask is set in each text."""
    total = np.concatenate([[0], np.cumsum(mask)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.where(whole > 0, part / np.maximum(whole, 1), 0.0)


def _counts(keys: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of each text, the count of its most frequent one, and a mask of all keys that
    were in their text before."""
    order = np.lexsort((np.arange(len(keys)), keys, of))
    k, t = keys[order], of[order]
    first = np.ones(len(k), dtype=bool)
    first[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    starts = np.flatnonzero(first)
    top = np.zeros(n)
    np.maximum.at(top, t[starts], np.diff(np.append(starts, len(k))))
    again = np.zeros(len(k), dtype=bool)
    again[order] = ~first
    return np.bincount(t[starts], minlength=n).astype(np.float64), top, again


def statistics(texts: list[str]) -> np.ndarray:
    """(texts x FEATURES); an empty text is all zeros."""
    n = len(texts)
    if not n:
        return np.zeros((0, len(FEATURES)))
    cp, offsets = code_points([t + "\n" for t in texts])
    white = (cp <= 32) | (cp == 0xA0)
    letter, digit = letters(cp), (cp >= 48) & (cp <= 57)
    low = lowered(cp)
    mark = ~(white | letter | digit)
    chars = np.diff(offsets) - 1.0
    solid = _per_text(~white, offsets)
    n_letters = _per_text(letter, offsets)

    starts, ends = runs(np.append(~white, False)) if len(cp) else (np.zeros(0, np.int64),) * 2
    first = np.searchsorted(starts, offsets)
    words = np.diff(first).astype(np.float64)
    of = np.repeat(np.arange(n), np.diff(first))
    hashes = SpanHasher(mix64(low.astype(np.uint64)))(starts, ends)
    distinct, top, _ = _counts(hashes, of, n)
    follows = np.zeros(len(of), dtype=bool)
    follows[1:] = of[1:] == of[:-1]
    repeat = np.zeros(len(of), dtype=bool)
    repeat[1:] = follows[1:] & (hashes[1:] == hashes[:-1])
    pairs = mix64(hashes[1:] ^ mix64(hashes[:-1] ^ _SALT))[follows[1:]]
    distinct_pairs, _, _ = _counts(pairs, of[1:][follows[1:]], n)
    by_word = lambda mask: np.bincount(of[mask], minlength=n).astype(np.float64)
    inked = np.concatenate([[0], np.cumsum(letter | digit)])
    usual = np.isin(cp, [ord(c) for c in USUAL_ENDS])

    line_end = np.flatnonzero(cp == 10)
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    filled = line_end > line_start
    line_start, line_end = line_start[filled], line_end[filled]
    line_of = np.searchsorted(offsets, line_start, side="right") - 1
    lines = np.bincount(line_of, minlength=n).astype(np.float64)
    line_hashes = SpanHasher(cp.astype(np.uint64) + np.uint64(1))(line_start, line_end)
    _, _, again = _counts(line_hashes, line_of, n)
    copied = np.bincount(line_of[again], weights=(line_end - line_start)[again].astype(np.float64), minlength=n)

    columns = {
        "log_chars": np.log1p(chars),
        "log_words": np.log1p(words),
        "word_length": _share(solid, words),
        "letter_share": _share(n_letters, solid),
        "upper_share": _share(_per_text(letter & (low != cp), offsets), n_letters),
        "digit_share": _share(_per_text(digit, offsets), solid),
        "mark_share": _share(_per_text(mark, offsets), solid),
        "stops_per_word": _share(_per_text(np.isin(cp, [ord(c) for c in STOPS]), offsets), words),
        "lone_mark_share": _share(by_word(inked[ends] == inked[starts]), words),
        "marked_end_share": _share(by_word((mark & ~usual)[ends - 1]), words),
        "repeat_share": _share(by_word(repeat), words),
        "distinct_words": _share(distinct, words),
        "top_word_share": _share(top, words),
        "distinct_pairs": _share(distinct_pairs, words - 1),
        "log_lines": np.log1p(lines),
        "words_per_line": _share(words, lines),
        "repeated_line_share": _share(copied, chars),
    }
    return np.stack([columns[c] for c in FEATURES], axis=1)


# --- rules ------------------------------------------------------------------------------------

#: (feature number, threshold, True: above it, False: up to it)
Condition = tuple[int, float, bool]


@dataclass
class RuleModel:
    rules: list[tuple[Condition, ...]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    intercept: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return holds(self.rules, x) @ np.array(self.weights, dtype=np.float64) + self.intercept

    def column(self) -> Column:
        """The score as an expression over the columns :data:`FEATURES`."""
        logit = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights):
            logit = logit + F.when(_condition(rule), float(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))


def _condition(rule: tuple[Condition, ...]) -> Column:
    out = F.lit(True)
    for j, threshold, above in rule:
        c = F.col(FEATURES[j])
        out = out & ((c > float(threshold)) if above else (c <= float(threshold)))
    return out


def holds(rules: list[tuple[Condition, ...]], x: np.ndarray) -> np.ndarray:
    """(rows x rules) 1.0 where a rule holds."""
    out = np.ones((len(x), len(rules)))
    for r, rule in enumerate(rules):
        for j, threshold, above in rule:
            out[:, r] *= (x[:, j] > threshold) if above else (x[:, j] <= threshold)
    return out


def _tidy(rule: list[Condition]) -> tuple[Condition, ...]:
    """One condition for each feature and direction: the strictest."""
    best: dict[tuple[int, bool], float] = {}
    for j, threshold, above in rule:
        old = best.get((j, above))
        best[j, above] = threshold if old is None else (max if above else min)(old, threshold)
    return tuple(sorted((j, t, above) for (j, above), t in best.items()))


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    """Up to BINS - 1 thresholds of every feature, halfway between neighbouring quantiles."""
    out = []
    for j in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1), method="lower"))
        out.append((q[1:] + q[:-1]) / 2)
    return out


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[tuple[Condition, ...]]:
    """All paths from a root to a node of boosted trees (logistic loss, Newton leaves)."""
    cuts = _cuts(x)
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    logit = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    least = 2 + len(y) // ROWS_PER_MIN_ROW
    rules: dict[tuple[Condition, ...], None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = y - p, p * (1 - p)
        if np.abs(g).mean() < 1e-4:
            break
        todo: list[tuple[np.ndarray, list[Condition], int]] = [(np.arange(len(y)), [], 0)]
        while todo:
            rows, path, level = todo.pop()
            split = _best_split(binned[rows], g[rows], h[rows], cuts, least) if level < depth else None
            if split is None:
                logit[rows] += SHRINKAGE * np.clip(g[rows].sum() / (h[rows].sum() + 1.0), -4, 4)
                continue
            j, b = split
            above = binned[rows, j] > b
            for side in (False, True):
                longer = [*path, (j, float(cuts[j][b]), side)]
                rules.setdefault(_tidy(longer))
                todo.append((rows[above == side], longer, level + 1))
    return list(rules)


def _best_split(binned: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], least: int) -> tuple[int, int] | None:
    """(feature, bin): rows up to the bin go one way; the first of the greatest gains."""
    best, found = 1e-6, None
    total_g, total_h = g.sum(), h.sum()
    base = total_g**2 / (total_h + 1.0)
    for j, c in enumerate(cuts):
        if not len(c):
            continue
        size = len(c) + 1
        gs = np.cumsum(np.bincount(binned[:, j], g, size))[:-1]
        hs = np.cumsum(np.bincount(binned[:, j], h, size))[:-1]
        ns = np.cumsum(np.bincount(binned[:, j], minlength=size))[:-1]
        gain = gs**2 / (hs + 1.0) + (total_g - gs) ** 2 / (total_h - hs + 1.0) - base
        gain[(ns < least) | (len(g) - ns < least)] = 0
        b = int(gain.argmax())
        if gain[b] > best:
            best, found = float(gain[b]), (j, b)
    return found


def lasso(r: np.ndarray, y: np.ndarray, penalty: float, start: np.ndarray | None = None, steps: int = STEPS) -> np.ndarray:
    """Weights (the last one the intercept, not penalised) of the L1 logistic model on the columns
    of ``r``, by accelerated proximal gradient steps."""
    a = np.hstack([r, np.ones((len(r), 1))])
    rate = 4 * len(y) / max(1.0, _largest_eigenvalue(a))
    w = np.zeros(a.shape[1]) if start is None else start.copy()
    v, t = w.copy(), 1.0
    for _ in range(steps):
        slope = a.T @ (1 / (1 + np.exp(-np.clip(a @ v, -500, 500))) - y) / len(y)
        new = v - rate * slope
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w


def _largest_eigenvalue(a: np.ndarray) -> float:
    gram = a.T @ a
    v = np.ones(len(gram))
    for _ in range(30):
        v = gram @ v
        v /= np.linalg.norm(v)
    return float(v @ gram @ v) * 1.05


def train(x: np.ndarray, y: np.ndarray) -> RuleModel:
    """Rules and weights from statistics and 0/1 labels. Every fifth row is left out: the penalty
    and the threshold are chosen on those. Without rows of both labels: no rules, a constant."""
    if not len(y) or y.min() == y.max():
        p = float(y.mean()) if len(y) else 0.5
        return RuleModel(intercept=float(np.log((p + 0.01) / (1.01 - p))))
    apart = np.arange(len(y)) % 5 == 4
    if not apart.any() or y[apart].min() == y[apart].max() or y[~apart].min() == y[~apart].max():
        apart = np.zeros(len(y), dtype=bool)
    check = apart if apart.any() else ~apart
    rules = grow_rules(x[~apart], y[~apart])
    r, own = holds(rules, x), y[~apart]
    if rules:
        centred = r[~apart] - r[~apart].mean(axis=0)
        most = np.abs(centred.T @ (own - own.mean())).max() / len(own)
    best, w = None, None
    for share in PENALTIES if rules else ():
        w = lasso(r[~apart], own, share * most, w)
        z = r[check] @ w[:-1] + w[-1]
        loss = float(np.logaddexp(0, np.where(y[check] == 1, -z, z)).mean())
        if best is None or loss < best[0] * 0.98:  # a weaker penalty must be worth its rules
            best = (loss, w)
    if best is None:
        return RuleModel(intercept=float(np.log(y.mean() / (1 - y.mean()))))
    w = best[1]
    kept = np.flatnonzero(np.abs(w[:-1]) > 1e-6)
    model = RuleModel([rules[i] for i in kept], w[kept].tolist(), float(w[-1]))
    model.intercept += float(np.log(DECISION / (1 - DECISION))) - _best_threshold(model.logits(x[check]), y[check])
    return model


def _best_threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The logit of best balanced accuracy, halfway to the next smaller one."""
    order = np.argsort(-z, kind="stable")
    z, y = z[order], y[order]
    gain = np.cumsum(y) / y.sum() - np.cumsum(1 - y) / (1 - y).sum()
    gain[:-1][z[1:] == z[:-1]] = -2  # equal logits stay on one side
    i = int(gain.argmax())
    return float((z[i] + z[i + 1]) / 2) if i + 1 < len(z) else float(z[i] - 1e-3)


# --- jobs -------------------------------------------------------------------------------------


def describe(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row and the statistics of its ``text`` (NULL: empty)."""

    def run(texts, batch):
        x = statistics(texts)
        return {c: row_ids(batch, c) for c in keep} | {c: x[:, j] for j, c in enumerate(FEATURES)}

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + [f"{c} double" for c in FEATURES]
    return map_slices(docs.select(*dict.fromkeys([*keep, "text"])), run, ", ".join(kinds))


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0) -> RuleModel:
    """Learn from labelled texts outside the held-out fold. A document with several labels is bad
    if one says so. At most ``MAX_PER_LABEL`` ids of each label (those of least hash), and as many
    different rows of statistics in all, ever reach the driver or a broadcast."""
    known = (
        labels.filter(F.col("quality").isin(0, 1) & (fold(modulus) != held_out))
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("good"))
    )
    chance = F.xxhash64(F.lit("quality"), "doc_id")
    chosen = None
    for label in (0, 1):
        some = known.filter(F.col("good") == label).orderBy(chance, "doc_id").limit(MAX_PER_LABEL)
        chosen = some if chosen is None else chosen.unionByName(some)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = (
        describe(rows, ["doc_id", "good"]).distinct()
        .orderBy(F.xxhash64(F.lit("rows"), "doc_id", *FEATURES), "doc_id", *FEATURES).limit(2 * MAX_PER_LABEL)
        .select("good", *FEATURES).collect()
    )
    x = np.array([r[1:] for r in sample], dtype=np.float64).reshape(len(sample), len(FEATURES))
    return train(x, np.array([r["good"] for r in sample], dtype=np.float64))


def classify(docs: DataFrame, model: RuleModel, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row, score and predicted."""
    scored = describe(docs, keep).select(*keep, model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= DECISION).cast("int"))


def op13_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    NULL texts are scored as empty ones (all statistics zero). Long texts are described whole.
    Repeated rows give equal scores; a NULL id is not held out. Without labels of both kinds the
    score is a constant. Other columns are not read; no rows give no rows."""
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    rows = docs.select("doc_id", "text", in_fold(5, 0).alias("held_out"))
    return classify(rows, model, ["doc_id", "held_out"])
