"""Operator 6: the query against the definition, one text after another."""

import hashlib
import random

from meeple.llm import fingerprint as fp


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


def corpus():
    rng = random.Random(2)
    rows = [(i * 3, prose(rng, rng.choice([0, 3, 50, 400]))) for i in range(60)]
    return rows + [(1000, None), (1001, ""), (1002, "x"), (1003, "a" * 20_000), (1004, prose(rng, 20_000)), (1005, "déjà " * 40)]


def test_query_equals_the_definition(docs, spark):
    rows = corpus()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = {r["doc_id"]: r for r in fp.op6_fingerprint(docs(rows)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    other = {r["doc_id"]: r for r in fp.op6_fingerprint(docs(rows)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == other and len(got) == len(rows)
    texts = [t or "" for _, t in rows]
    for k, (doc_id, _) in enumerate(rows):
        text, nxt = texts[k], texts[(k + 1) % len(rows)]
        half = len(text) // 2
        changed = text[: len(text) - half] + nxt[:half]
        r = got[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        own, edited, following = fp.fingerprints([text])[0], fp.fingerprints([changed])[0], fp.fingerprints([nxt])[0]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own, edited)
        assert r["near_edited"] == fp.likeness(own, edited) and r["near_next"] == fp.likeness(own, following)


def test_half_a_text_is_alike():
    rng = random.Random(5)
    for n in (60, 300, 3000):
        a, b = prose(rng, n), prose(rng, n)
        mixed = a[: len(a) // 2] + b[: len(a) // 2]
        x, y, z = fp.fingerprints([a, mixed, b])
        assert fp.likeness(x, y) > 0.3 > fp.likeness(x, z)
        assert fp.likeness(x, x) == 1.0


def test_common_subsequence_equals_the_table():
    rng = random.Random(7)
    for _ in range(200):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
        b = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
        row = [0] * (len(b) + 1)
        for c in a:
            new = [0]
            for j, d in enumerate(b):
                new.append(row[j] + 1 if c == d else max(row[j + 1], new[j]))
            row = new
        assert fp._common_subsequence(a, b) == row[-1]


def test_slices_do_not_matter_and_ties(docs):
    texts = ["one two three " * 30, "", "b" * 500]
    assert fp.fingerprints(texts) == [fp.fingerprints([t])[0] for t in texts]
    got = fp.op6_fingerprint(docs([(1, "b b"), (1, "a a"), (None, "c c")])).collect()
    assert len(got) == 3
    single = fp.op6_fingerprint(docs([(1, "abcd")])).first()
    assert single["near_next"] == 1.0  # it follows itself
    assert fp.op6_fingerprint(docs([])).count() == 0
    assert fp.fingerprint(docs([(1, "abcd")])).first()["fingerprint"] == fp.fingerprints(["abcd"])[0]


def test_texts_without_an_id_are_spread(docs, spark):
    """NULL ids do not all land in one task; rows of one id follow each other by the text's hash."""
    rng = random.Random(9)
    rows = [(None, prose(rng, 20)) for _ in range(400)] + [(5, prose(rng, 20)) for _ in range(100)]
    df = docs(rows)
    got = fp.op6_fingerprint(df).collect()
    ids = {r["text"]: (r["doc_id"] is not None, r["h"]) for r in df.selectExpr("doc_id", "text", "xxhash64(text) h").collect()}
    order = sorted(ids, key=lambda t: ids[t])
    want = set()
    for k, text in enumerate(order):
        nxt, half = order[(k + 1) % len(order)], len(text) // 2
        want.add(hashlib.sha256((text[: len(text) - half] + nxt[:half]).encode()).hexdigest())
    assert len(got) == len(rows) and {r["edited_sha256"] for r in got} == want
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = df.selectExpr("doc_id", "xxhash64(text) _hash").repartitionByRange(n, "doc_id", "_hash")
    assert max(r["count"] for r in hashed.groupBy(fp.F.spark_partition_id()).count().collect()) < len(rows) / 2
