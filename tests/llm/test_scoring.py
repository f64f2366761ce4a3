"""Operator 4: exact unigram scores, and what the filter may and may not do."""

import collections
import math
import random
import re
import zlib

import numpy as np

from meeple.llm import scoring


def corpus():
    rng = random.Random(6)
    words = ["w%d" % i for i in range(40)]
    rows = []
    for i in range(120):
        rows.append((i, " ".join(words[min(39, int(rng.expovariate(0.1)))] for _ in range(rng.randint(0, 50)))))
    return rows + [(500, None), (501, ""), (502, " \t\n"), (503, "W1 w1\x0bÉ é"), (503, "w2 w3"), (504, "w1 " * 20_000)]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) + [None]


def test_base_scores_are_exact(docs):
    rows = corpus()
    train = [split(t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    count = collections.Counter(w for t in train for w in t)
    n, v = sum(count.values()), len(count)
    got = scoring.op4_lm_score(docs(rows)).collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for i, t in rows:
        w = split(t)
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)
        want[(i, zlib.crc32(str(i).encode()) % 7 == 2, len(w), sum(count[x] > 0 for x in w), n, round(base, 6))] += 1
    have = collections.Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
    assert have == want
    assert all(r["score"] <= 0 for r in got)


def test_empty_and_null_ids(docs):
    assert scoring.op4_lm_score(docs([])).count() == 0
    got = scoring.op4_lm_score(docs([(None, "a a"), (1, "a")])).collect()
    assert {r["n_tokens"] for r in got} == {2, 3}


def test_filter_returns_quantised_counts():
    """No n-gram is lost, counts are within a factor of two, few absent ones are found."""
    rng = np.random.default_rng(1)
    shards, region = 4, 1 << 15
    grams = rng.integers(0, 2**63, size=4000, dtype=np.uint64)
    counts = rng.integers(2, 500, size=4000)
    bits = np.zeros(shards * region, dtype=np.uint8)
    level = scoring._levels(counts)
    for j in range(1, int(level.max()) + 1):
        own = grams[level >= j]
        for i in range(scoring.FIRST_PROBES if j == 1 else scoring.MORE_PROBES):
            bits[scoring._places(scoring._shard(own, shards), own & scoring._LOW, 1, j, i, region)] = 1
    f = scoring.CountFilter(np.packbits(bits, bitorder="little"), region, shards, 2, 1, 1, 1)
    got = f.counts(grams, 1)
    assert (got > 0).all() and (got * 1.42 >= counts / 1.0 / 1.42).all()
    assert (got <= 2 * counts).mean() > 0.8  # a false level above is possible, but rare
    absent = rng.integers(0, 2**63, size=4000, dtype=np.uint64)
    assert (f.counts(absent, 1) > 0).mean() < 0.1


def test_known_texts_are_likelier(docs):
    text = "alpha beta gamma delta epsilon zeta"
    rows = [(i, text) for i in range(60)] + [(100, "zeta alpha epsilon beta delta gamma")]
    got = {r["doc_id"]: r["score"] for r in scoring.score(docs(rows), scoring.F.col("doc_id") < 100).collect()}
    assert got[3] > got[100]


def test_every_seen_ngram_is_kept_at_any_size(docs, monkeypatch):
    """A word seen once counts once, and a filter in many broadcasts scores as one in a single one."""
    rng = random.Random(2)
    rows = [(i, " ".join("v%d" % rng.randrange(4000) for _ in range(60))) for i in range(200)]
    rows += [(1000, "once seen"), (1001, None), (1002, "once"), (1003, "never")]
    train = scoring.F.col("doc_id") < 1001
    whole = {r["doc_id"]: r for r in scoring.score(docs(rows), train).collect()}
    assert whole[1002]["n_known"] == 2 and whole[1003]["n_known"] == 1  # the end is known
    assert whole[1002]["score"] > whole[1003]["score"] + 0.2
    monkeypatch.setattr(scoring, "SEGMENT_BYTES", 3000)
    parts = {r["doc_id"]: r for r in scoring.score(docs(rows), train).collect()}
    assert set(parts) == set(whole)
    for i, r in whole.items():
        assert (parts[i]["n_tokens"], parts[i]["n_known"]) == (r["n_tokens"], r["n_known"])
        assert abs(parts[i]["score"] - r["score"]) < 1e-9
    assert len(whole) == len(rows)


def test_rows_keep_their_scores_when_a_later_scan_is_split_otherwise(spark, docs, tmp_dir, monkeypatch):
    rows = [(i, "w%d " % (i % 50) * (1 + i % 7)) for i in range(400)]
    docs(rows).repartition(16).write.parquet(f"{tmp_dir}/texts")
    table = spark.read.parquet(f"{tmp_dir}/texts")
    train = scoring.F.col("doc_id") < 300
    whole = {r["doc_id"]: r for r in scoring.score(table, train).collect()}
    count = scoring._count
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def then_split(*args):
        out = scoring.stage(count(*args), "counted")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # as cores come or go
        return out

    monkeypatch.setattr(scoring, "_count", then_split)
    try:
        got = {r["doc_id"]: r for r in scoring.score(table, train).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got.keys() == whole.keys() and len(whole) == len(rows)
    for i, r in whole.items():
        assert got[i]["n_known"] == r["n_known"] == r["n_tokens"] and abs(got[i]["base_score"] - r["base_score"]) < 1e-9


def test_scores_equal_a_plain_model(docs, monkeypatch):
    """Levels read from the filter against true counts (never below, mostly equal), and every score
    against the interpolation of the levels' counts in plain Python."""
    import math

    rng = random.Random(6)
    vocabulary = ["w%d" % int(rng.paretovariate(0.7)) for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 50)))) for i in range(300)]
    train = [t.split() for i, t in rows if i < 240]
    words, spans = {}, {}
    for t in train:
        for a, b in zip([None, *t], [*t, "END"]):
            words[b] = words.get(b, 0) + 1
            spans[a, b] = spans.get((a, b), 0) + 1
    total, different = sum(words.values()), len(words)

    numbered = docs(rows).select(scoring.F.col("doc_id").alias("row"), (scoring.F.col("doc_id") < 240).alias("train"), "text")
    parts, fetch = scoring._segments(scoring.stage(scoring._count(numbered, 8), "counted"), 8, len(train))
    model = fetch(*parts[0])
    assert (model.tokens, model.words) == (total, different)
    middle = lambda mark: 0.0 if mark == 0 else 1.0 if mark == 1 else 2.0 ** (int(mark) - 0.5)
    level = lambda c: 0 if c == 0 else 1 + math.floor(math.log2(c))
    monkeypatch.setattr(scoring, "shards", lambda *args: 8)  # the same filter
    got = {r["doc_id"]: r["score"] for r in scoring.score(docs(rows), scoring.F.col("doc_id") < 240).collect()}
    same = []
    for i, text in rows:
        t = [*text.split(), "END"]
        token, offsets = scoring.tokens([text])
        word_marks, pair_marks = model.marks(token, 1), model.marks(scoring.pairs(token, offsets), 2)
        out, before = 0.0, float(len(train))
        for k, b in enumerate(t):
            a = t[k - 1] if k else None
            for mark, true in ((word_marks[k], words.get(b, 0)), (pair_marks[k], spans.get((a, b), 0))):
                assert mark >= level(true)
                same.append(mark == level(true))
            own = middle(word_marks[k])
            pair = min(middle(pair_marks[k]), max(own, 1.0))
            weight = scoring.PAIR_WEIGHT if before > 0 else 0.0
            ratio = min(pair / max(before, 1.0), 1.0) if before > 0 else 0.0
            out += math.log10(min(weight * ratio + (1 - weight) * (own + 1) / (total + different + 1), 1.0))
            before = own
        assert abs(got[i] - out) < 1e-9
    assert sum(same) / len(same) > 0.7


def test_texts_are_read_once_whatever_the_filter(docs, monkeypatch):
    monkeypatch.setattr(scoring, "SEGMENT_BYTES", 2000)
    monkeypatch.setattr(scoring, "HELD_BYTES", 3000)
    staged = []
    plain = scoring.stage
    monkeypatch.setattr(scoring, "stage", lambda df, label, *a: staged.append(label) or plain(df, label, *a))
    rng = random.Random(7)
    rows = [(i, " ".join("v%d" % rng.randrange(3000) for _ in range(40))) for i in range(150)]
    got = scoring.score(docs(rows), scoring.F.col("doc_id") < 100)
    assert got.count() == 150 and staged == ["numbered-texts", "ngram-counts"]
