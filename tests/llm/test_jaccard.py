"""Operator 8 and the components against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from meeple.llm import jaccard
from meeple.llm.common import connected_components


def split(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def roots(nodes, links):
    parent = {a: a for a in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {a: find(a) for a in nodes}


def brute(rows):
    sets = {i: split(t) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    part = roots(ids, links)
    return {i: (len(sets[i]), part[i]) for i in ids}, links


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        k = rng.randrange(len(words))
        rng.choice([lambda: words.__setitem__(k, "x%d" % rng.randrange(10**6)), lambda: words.pop(k), lambda: words.insert(k, "y")])()
    return words


def corpus(seed, n=140):
    """Originals, edited copies of copies, a passage that many texts share, exact copies."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.45:
            base = rng.choice(texts[-12:])
            texts.append(edited(rng, base, rng.randint(0, max(1, len(base) // 22))) if base else [])
        elif kind < 0.7:
            own = [rng.choice(vocabulary) for _ in range(rng.choice([6, 12, 20, 60]))]
            texts.append(passage[: rng.randint(20, 60)] + own if rng.random() < 0.5 else own + passage)
        else:
            texts.append([rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 8, 40, 120]))])
    return [(7 * i + 1, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_brute_force(docs, seed):
    rows = corpus(seed) + [(5000, None), (5001, ""), (5002, " \n"), (5003, "A b\tC"), (5004, "a B c"), (5005, "w1 " * 9000), (5006, "w1 " * 8000)]
    want, links = brute(rows)
    assert len(links) > 40
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.op8_jaccard(docs(rows)).collect()}
    assert got == want


def test_hot_group_of_near_copies(docs):
    """Half of all texts are edits of one original: whole result, and few pairs are looked at."""
    rng = random.Random(4)
    base = ["w%d" % rng.randrange(500) for _ in range(120)]
    rows = [(i, " ".join(edited(rng, base, 2) if i else base)) for i in range(150)]
    rows += [(1000 + i, " ".join("v%d" % rng.randrange(10**6) for _ in range(50))) for i in range(150)]
    want, _ = brute(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.op8_jaccard(docs(rows)).collect()}
    assert got == want


def test_repeated_rows_and_empty_tables(docs):
    got = jaccard.op8_jaccard(docs([(3, "a b c"), (3, "a b c"), (2, "A B C"), (9, ""), (None, "a b c")])).collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in got) == [("2", 2), ("3", 2), ("3", 2), ("9", 9), ("None", 2)]
    assert jaccard.op8_jaccard(docs([])).count() == 0


def test_threshold_is_inclusive(docs):
    """7 shared of 9 + ... shingles: exactly 3/4 links, one less does not."""
    a = ["a%d" % i for i in range(11)]  # 7 shingles
    b = a + ["b"]  # 8: 7/8
    c = a[:10] + ["c", "d"]  # 8: shares 6 of 9
    want, links = brute([(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.op8_jaccard(docs([(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))])).collect()}
    assert got == want and links == [(1, 2)]


def test_packing_is_lossless():
    rng = np.random.default_rng(3)
    tokens = np.sort(rng.integers(0, 2**64, size=5000, dtype=np.uint64))
    rows = rng.integers(0, 65536, size=5000)
    for n in (1, 7, 200, 65536):
        parts = [jaccard._unpack(d) for _, d in jaccard._pack(tokens, rows, n)]
        assert (np.concatenate([p[0] for p in parts]) == tokens).all()
        assert (np.concatenate([p[1] for p in parts]) == rows).all()


def test_pivot_bounds_are_sound():
    """The bounds that decide pairs hold for random sets."""
    rng = random.Random(1)
    for _ in range(500):
        p, x, y = ({rng.randrange(12) for _ in range(rng.randint(1, 10))} for _ in range(3))
        ox, oy = len(p & x), len(p & y)
        assert ox + oy - len(p) <= len(x & y) <= min(ox, oy) + min(len(x) - ox, len(y) - oy)


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(500, 501), (501, 502), (502, 500)]
    links += [(rng.randrange(600, 700), rng.randrange(600, 700)) for _ in range(60)] + [(5, 5)]
    df = spark.createDataFrame(links, "x long, y long")
    got = {r["node"]: r["component"] for r in connected_components(df, "x", "y").collect()}
    assert got == roots({a for link in links if link[0] != link[1] for a in link}, links)
    assert connected_components(df.filter(F.lit(False)), "x", "y").count() == 0


@pytest.mark.parametrize("partitions", [64, 256])
def test_documents_spread_over_the_shards(spark, docs, partitions, monkeypatch):
    """Batch numbers are multiples of 2**32: their groups must not fall together."""
    keys = {}
    monkeypatch.setattr(jaccard, "_BATCH_CHARS", 200)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    seen = []
    plain = jaccard.stage
    monkeypatch.setattr(jaccard, "stage", lambda df, label, *a: seen.append(plain(df, label, *a)) or seen[-1])
    monkeypatch.setattr(jaccard, "unstage", lambda *frames: None)
    try:
        rows = [(i, "word%d and some more words of this text here" % i) for i in range(600)]
        jaccard.components(docs(rows).repartition(120)).count()
        keys = [r["shard"] for r in seen[0].filter("shard < 0").select("shard").distinct().collect()]
        batches = seen[0].filter("shard < 0").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert batches >= 100
    assert len(keys) > 0.6 * batches  # of 256 or more places


def test_every_admissible_pair_meets_in_one_block(spark):
    rng = np.random.default_rng(8)
    n = np.concatenate([rng.integers(1, 30, 500), rng.integers(30, 3000, 500)])
    pos = (rng.random(1000) * (n - -(-75 * n // 100) + 1)).astype(int)
    rows = [(i, 0, int(a), int(b)) for i, (a, b) in enumerate(zip(n, pos))]
    entries = spark.createDataFrame(rows, "cid long, token long, n long, pos long").cache()
    pairs = entries.alias("p").join(entries.alias("q"), (F.col("p.token") == F.col("q.token")) & (F.col("p.cid") != F.col("q.cid")))
    bounded = {"all": F.floor(F.col("n") * 100 / 75), "smaller": F.col("n")}
    for kind, largest in bounded.items():
        want = pairs.filter(jaccard._admissible("p", "q"))
        if kind == "smaller":
            want = want.filter("p.n >= q.n")
        met = jaccard._probed(entries, largest).alias("p").join(
            jaccard._indexed(entries).alias("q"), jaccard._same_block() & (F.col("p.cid") != F.col("q.cid"))
        )
        times = met.groupBy("p.cid", "q.cid").count()
        got = met.filter(jaccard._admissible("p", "q") & (F.lit(kind == "all") | (F.col("p.n") >= F.col("q.n"))))
        want_rows = {tuple(r) for r in want.select("p.cid", "q.cid").collect()}
        assert {tuple(r) for r in got.select("p.cid", "q.cid").collect()} == want_rows
        assert times.filter("count > 1").isEmpty()  # never twice
        by_size = jaccard._probed(entries.withColumn("pos", F.lit(0)), largest).select("cid", "band").distinct().alias("p").join(
            jaccard._indexed(entries).alias("q"), (F.col("p.band") == F.col("q.band")) & (F.col("p.cid") != F.col("q.cid"))
        )
        assert met.count() < 0.7 * by_size.count()  # positions skip blocks that sizes alone would read
