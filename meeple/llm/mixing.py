"""Mixing sources to target weights by temperature (operator 1).

With token shares p, a source's weight is p**alpha, normalised. The exponent is found by
bisection: the flattest mixture whose most repeated source is repeated at most
``repetition_limit`` times as often as the least repeated one, or the one with a given
entropy. Weights times the token budget give each source's tokens: whole passes over the
source, and a part of one more. Without a budget, the least repeated source is passed once, so
no document is left out.

A pass is a permutation in blocks: a hash of pass and document deals a source's documents to
about sqrt(n) blocks and orders them inside. What is taken of the last pass is a prefix of it,
so two numbers per source (a block and a place in it) describe the mixture, and applying them
to the documents needs no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meeple.llm.common import stage, unstage

REPETITION_LIMIT = 2.0
SEED = 20240115
_BROADCAST_SOURCES = 10_000
#: Exponents that one aggregate over the sources tries.
SECTIONS = 16


def tokens(text: str = "text"):
    """Tokens of a text: its words without ASCII white space (NULL: none)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weights(shares: np.ndarray, alpha: float) -> np.ndarray:
    """shares**alpha, normalised."""
    w = np.exp(alpha * np.log(shares))
    return w / w.sum()


def entropy(w: np.ndarray) -> float:
    return float(-(w * np.log(np.maximum(w, 1e-300))).sum())


def repetition(shares: np.ndarray, alpha: float) -> float:
    """How often the most repeated source is passed for each pass of the least repeated one."""
    r = weights(shares, alpha) / shares
    return float(r.max() / r.min())


def bisect(too_flat: Callable[[list[float]], list[bool]], sections: int = 2) -> float:
    """The least exponent in [0, 1] that is not too flat (or 1). ``too_flat`` judges several at once;
    every step leaves one of ``sections`` parts."""
    low, high = 0.0, 1.0
    if not too_flat([low])[0]:
        return low
    for _ in range(math.ceil(60 / math.log2(sections))):
        tried = [low + (high - low) * i / sections for i in range(1, sections)]
        flat = too_flat(tried)
        n = flat.index(False) if False in flat else len(tried)
        low, high = tried[n - 1] if n else low, tried[n] if n < len(tried) else high
    return high


def bisect_alpha(shares: np.ndarray, target_entropy: float | None = None, repetition_limit: float | None = REPETITION_LIMIT) -> float:
    """The least exponent in [0, 1] that keeps the repetition limit and does not exceed the target
    entropy (both fall as the exponent grows; limits out of reach end at 0 or 1)."""
    return bisect(lambda alphas: [
        (repetition_limit is not None and repetition(shares, a) > repetition_limit)
        or (target_entropy is not None and entropy(weights(shares, a)) > target_entropy)
        for a in alphas
    ])


def _alpha(sources: DataFrame, total: int, target_entropy: float | None, repetition_limit: float | None) -> float:
    """:func:`bisect_alpha` over a table of sources of any length. The repetition follows from the
    largest and the smallest share, (max / min) ** (1 - alpha); entropies from two sums for each
    exponent, ``SECTIONS`` exponents at a time."""
    ends = sources.agg(F.max("tokens").alias("most"), F.min("tokens").alias("least")).first()
    spread = math.log(ends["most"] / ends["least"])
    share = F.col("tokens") / F.lit(float(total))

    def too_flat(alphas: list[float]) -> list[bool]:
        out = [repetition_limit is not None and math.exp((1 - a) * spread) > repetition_limit for a in alphas]
        if target_entropy is None:
            return out
        power = lambda a: F.exp(F.lit(a) * F.log(share))
        sums = sources.agg(*[x for i, a in enumerate(alphas) for x in (F.sum(power(a)).alias(f"z{i}"), F.sum(power(a) * F.log(share)).alias(f"s{i}"))]).first()
        entropies = [math.log(sums[f"z{i}"]) - a * sums[f"s{i}"] / sums[f"z{i}"] for i, a in enumerate(alphas)]
        return [flat or h > target_entropy for flat, h in zip(out, entropies)]

    return bisect(too_flat, 2 if target_entropy is None else SECTIONS)


def budgets(sizes: DataFrame, budget_tokens: int | None, target_entropy: float | None, repetition_limit: float | None) -> DataFrame:
    """(source, docs, tokens) with weight, budget (tokens to draw), passes, rest, blocks, repeats. Sources
    without a token have weight 0 and are passed once. No source reaches the driver."""
    some = sizes.filter("tokens > 0")
    total = some.agg(F.sum("tokens")).first()[0]
    weight, whole = F.lit(0.0), 0.0
    if total:
        alpha = _alpha(some, total, target_entropy, repetition_limit)
        power = F.exp(F.lit(alpha) * F.log(F.col("tokens") / F.lit(float(total))))
        norm = some.agg(F.sum(power)).first()[0]
        weight = F.when(F.col("tokens") > 0, power / F.lit(norm)).otherwise(0.0)
        whole = float(budget_tokens) if budget_tokens is not None else some.agg(F.max(F.col("tokens") / (power / F.lit(norm)))).first()[0]
    exact = F.lit(whole) * F.col("weight")
    near = F.rint(exact)  # a whole number of tokens, without the last bits' noise
    budget = F.when(F.abs(exact - near) < 1e-6 * F.greatest(F.lit(1.0), exact), near).otherwise(F.floor(exact)).cast("long")
    rows = sizes.withColumn("weight", weight).withColumn("budget", budget)
    has = F.col("tokens") > 0
    passes = F.when(has, F.floor(F.col("budget") / F.col("tokens"))).otherwise(1).cast("int")
    return rows.withColumns({
        "passes": passes, "rest": F.when(has, F.col("budget") - passes * F.col("tokens")).otherwise(0).cast("long"),
        "blocks": (F.floor(F.sqrt(F.greatest(F.lit(0), F.col("docs") - 1))) + 1).cast("int"),
        "repeats": F.when(has, F.col("budget") / F.col("tokens")).otherwise(1.0),
    })


def _hash(epoch):
    """A document's place in a pass: 63 bits."""
    return F.xxhash64(F.lit(SEED), epoch, "doc_id").bitwiseAND(F.lit((1 << 63) - 1))


def _mixed(rows: DataFrame, mixture: DataFrame) -> DataFrame:
    """``rows`` with their source's columns of ``mixture`` (a written table, one short row a source:
    sent to every task while they are few, an ordinary join otherwise). NULL is a source."""
    short = mixture.withColumnRenamed("source", "of_source").drop("docs", "tokens", "budget")
    few = mixture.limit(_BROADCAST_SOURCES + 1).count() <= _BROADCAST_SOURCES
    return rows.join(F.broadcast(short) if few else short, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")


def _with(table: DataFrame, more: DataFrame) -> DataFrame:
    """``table`` left-joined to columns of ``more`` by source, NULL included."""
    other = more.withColumnRenamed("source", "of_source")
    return table.join(other, F.col("source").eqNullSafe(F.col("of_source")), "left").drop("of_source")


def plan(
    docs: DataFrame, budget_tokens: int | None = None, target_entropy: float | None = None,
    repetition_limit: float | None = REPETITION_LIMIT,
) -> DataFrame:
    """The mixture of ``docs`` (doc_id, source, text): a written table with a row for each source, any
    number of them. NULL is a source like any other. Of the part pass, blocks before ``cut_block``
    are taken whole, and of that one the hashes up to ``cut_hash``."""
    sizes = stage(docs.select("doc_id", "source", tokens().alias("n_tokens")), "doc-sizes")
    counted = stage(sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens")), "sources")
    mixture = stage(budgets(counted, budget_tokens, target_entropy, repetition_limit), "budgets")
    placed = _mixed(sizes, mixture).filter("rest > 0")
    placed = placed.withColumn("h", _hash(F.col("passes"))).withColumn("block", F.pmod("h", "blocks").cast("int"))
    # about sqrt(n) blocks a source: the first whose tokens no longer fit
    blocks = placed.groupBy("source", "block", "rest").agg(F.sum("n_tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy("source").orderBy("block"))
    full = blocks.withColumn("upto", upto).filter("upto > rest")
    cut = stage(
        full.groupBy("source").agg(F.min(F.struct("block", (F.col("upto") - F.col("tokens")).alias("before"))).alias("cut"))
        .select("source", F.col("cut.block").alias("cut_block"), F.col("cut.before").alias("before")), "cut-blocks",
    )
    # about sqrt(n) documents a source: the last one that fits
    edge = _with(placed, cut).filter("block = cut_block")
    run = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("h", "doc_id"))
    last = edge.withColumn("upto", run + F.col("before")).groupBy("source").agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("h"))).alias("cut_hash"))
    no_cut = F.when(F.col("rest") > 0, F.col("blocks")).otherwise(-1)
    out = stage(
        _with(_with(mixture, cut.drop("before")), last)
        .withColumns({"cut_block": F.coalesce("cut_block", no_cut), "cut_hash": F.coalesce("cut_hash", F.lit(-1).cast("long"))}), "mixture",
    )
    unstage(sizes, counted, mixture, cut)
    return out


def apply(docs: DataFrame, mixture: DataFrame) -> DataFrame:
    """Every document as often as the mixture takes it: the columns of ``docs`` plus epoch, block,
    turn (0 to 1: ordering all rows by it interleaves the sources by their weights) and weight."""
    names = docs.columns
    placed = _mixed(docs, mixture)
    h = _hash(F.col("passes"))
    block = F.pmod(h, F.col("blocks")).cast("int")
    more = (F.col("rest") > 0) & ((block < F.col("cut_block")) | ((block == F.col("cut_block")) & (h <= F.col("cut_hash"))))
    times = F.col("passes") + F.when(more, 1).otherwise(0)
    out = placed.withColumn("epoch", F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1)))).withColumn("_h", _hash(F.col("epoch")))
    out = out.withColumn("block", F.pmod("_h", "blocks").cast("int"))
    turn = (F.col("epoch") + (F.col("block") + F.col("_h") / F.lit(2.0**63)) / F.col("blocks")) / F.col("repeats")
    return out.withColumn("turn", F.least(turn, F.lit(1.0))).select(*names, "epoch", "block", "turn", "weight")


def op1_temperature_mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block, turn, weight of every document drawn, once for each
    time it is drawn.

    NULL and empty texts have no tokens and come along with their source; a source without any
    token is passed once. A NULL source is a source of its own. Repeated rows are drawn together
    (a document's place in a pass follows from its id). Other columns are not read; no rows give
    no rows."""
    rows = docs.select("doc_id", "source", "text")
    return apply(rows.select("doc_id", "source", tokens().alias("n_tokens")), plan(rows))
