"""Operator 5: held-out accuracy, calibration by language, odd texts."""

import random

import numpy as np

from meeple.llm import toxicity

CLEAN = "the of and to in is that it for on tree house river stone light morning".split()
RUDE = "idiot moron clown scumbag loser".split()


def corpus(n=600):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(CLEAN) for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(RUDE)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, docs):
    rows, labels = corpus()
    known = spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int")
    odd = [(5000, None), (5001, ""), (5002, "…"), (5003, "tree " * 50_000), (None, "idiot"), (1, rows[1][1])]
    got = toxicity.op5_toxicity(docs(rows + odd), known).collect()
    assert len(got) == len(rows) + len(odd)
    truth = dict(labels)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["doc_id"] in (5000, 5001, 5002, 5003):
            assert r["predicted"] == 0


def test_no_labels_or_one_class(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.op5_toxicity(docs([(1, "a b"), (2, None)]), none).collect()
    assert len({r["score"] for r in got}) == 1
    one = spark.createDataFrame([(1, 0, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    assert toxicity.op5_toxicity(docs([(1, "a b"), (2, "c")]), one).count() == 2
    assert toxicity.op5_toxicity(docs([]), none).count() == 0


def test_long_texts_keep_their_last_word():
    rows, labels = corpus()
    tokens = [toxicity.token_buckets([t])[0] for _, t in rows]
    model = toxicity.train(tokens, np.array([t for _, t in labels], np.float32), np.ones(len(rows)))
    clean, rude = model.score(["tree river " * 20_000, "tree river " * 20_000 + "moron"])
    assert clean < 0.3 <= rude


def test_threshold_is_the_best_split():
    z = np.array([3.0, 2.0, 1.0, 0.0])
    cut = toxicity._best_threshold(z, np.array([1.0, 1.0, 0.0, 0.0]), np.ones(4))
    assert 1.0 < cut < 2.0


def random_model(seed=3):
    model = toxicity._untrained(np.random.default_rng(seed))
    model.bias[:] = np.random.default_rng(seed + 1).normal(0, 0.2, size=len(model.bias))
    return model


def test_forward_pass_equals_the_definition():
    """Every filter's largest response over a text's own windows, one window after another; the
    texts beside it make no difference."""
    model = random_model()
    texts = ["tree house river", "", "idiot", "the light of the morning is on the stone " * 30, "moron " * 3, "a b"]
    want = []
    for text in texts:
        words, _ = toxicity.token_buckets([text])
        x = [sum(model.embedding[b] for b in row) for row in words] + [np.zeros(toxicity.DIM)] * 4
        z = model.intercept
        for i, (width, kernel) in enumerate(zip(toxicity.WIDTHS, model.kernels)):
            for f in range(toxicity.FILTERS):
                top = max(sum(float(x[p + j] @ kernel[j][:, f]) for j in range(width)) for p in range(len(words) + 1))
                k = i * toxicity.FILTERS + f
                z += max(top + model.bias[k], 0) * model.weights[k]
        want.append(z)
    assert np.allclose(model.logits(*toxicity.token_buckets(texts)), want, atol=1e-4)
    assert np.allclose(model.logits(*toxicity.token_buckets(texts[::-1])), want[::-1], atol=1e-4)
    assert np.allclose(model.score(texts), [model.score([t])[0] for t in texts], atol=1e-6)


def test_thresholds_by_language():
    """Two languages with ten toxic calibration rows each get thresholds of their own, a third one
    that of all rows."""
    model = random_model()
    rng = random.Random(2)
    words = {k: toxicity.FUNCTION_WORDS[k].split()[:8] for k in ("en", "de", "it")}
    texts, y = [], []
    for lang, n in (("en", 60), ("de", 60), ("it", 12)):
        for i in range(n):
            texts.append(" ".join(rng.choice(words[lang]) for _ in range(12)))
            y.append(float(i % 4 == 0))
    tokens, y, w = [toxicity.token_buckets([t])[0] for t in texts], np.array(y), np.ones(len(texts))
    toxicity._calibrate(model, tokens, y, w, np.ones(len(texts), bool))
    z = model.logits(*toxicity.token_buckets(texts))
    lang = model.languages(*toxicity.token_buckets(texts))

    def f1(rows, cut):
        called = [i for i in rows if z[i] > cut]
        return 2 * sum(y[called]) / (len(called) + sum(y[rows]))

    for name, rows in [("en", None), ("de", None), ("it", list(range(len(texts))))]:
        k = toxicity.LANGUAGES.index(name)
        rows = np.flatnonzero(lang == k).tolist() if rows is None else rows
        assert len(rows) >= 55
        best = max(f1(rows, cut) for cut in [z.min() - 1, *(z[rows] - 1e-6)])
        assert abs(f1(rows, model.thresholds[k]) - best) < 1e-6
    assert len(set(model.thresholds[[toxicity.LANGUAGES.index(k) for k in ("en", "de", "it")]])) == 3


def many_words(n=3000, words=150):
    """Every other text has one of many toxic words, each in a few texts only."""
    rng = random.Random(6)
    rude = ["".join(rng.choice("bdgkpt") + rng.choice("aeiou") for _ in range(4)) for _ in range(words)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(CLEAN) for _ in range(8)]
        if i % 2 == 0:
            text[rng.randrange(8)] = rude[i // 2 % words]
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 2 == 0)))
    return rows, labels


def test_all_labelled_texts_are_learnt_from(spark, docs, monkeypatch):
    """Words that a sample of the texts would miss are known, with one shard and with several, however the
    table is split."""
    rows, labels = many_words()
    known = spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int")
    for name in ("MAX_POSITIVE", "MAX_NEGATIVE"):  # former bounds of a sample
        monkeypatch.setattr(toxicity, name, 100, raising=False)
    models = []
    for size, parts in ((1 << 20, 2), (1 << 15, 1), (1 << 15, 7)):
        monkeypatch.setattr(toxicity, "SHARD_BYTES", size, raising=False)
        models.append(toxicity.fit(docs(rows, extra=False).repartition(parts), known))
        called = models[-1].score([t for _, t in rows]) >= 0.3
        assert np.mean(called == np.array([t for _, t in labels])) > 0.97
    assert np.allclose(models[1].embedding, models[2].embedding, atol=1e-5)
    assert np.allclose(models[1].thresholds, models[2].thresholds, atol=1e-2)
    assert abs(models[0].intercept - models[1].intercept) > 1e-6  # averaged from several shards


def packed(spark, rows, labels):
    words = [toxicity.token_buckets([t])[0] for _, t in rows]
    y = [t for _, t in labels]
    frame = spark.createDataFrame(
        [(k, i, bytearray(w.tobytes())) for i, (w, k) in enumerate(zip(words, y))], "toxic int, place long, tokens binary"
    )
    return words, np.array(y, np.float32), frame


def test_counts_and_thresholds_come_from_all_rows(spark):
    rows, labels = many_words(900)
    words, y, frame = packed(spark, rows, labels)
    seen = {}
    for w, k in zip(words, y):
        for b in set(w.ravel().tolist()):
            seen[int(k), b] = seen.get((int(k), b), 0) + 1
    got = toxicity._count_documents(frame.repartition(5))
    assert {(k, b): got[k, b] for k, b in zip(*map(np.ndarray.tolist, np.nonzero(got)))} == seen
    model, want = random_model(), random_model()
    toxicity._calibrate(want, words, y, np.ones(len(y)), np.ones(len(y), bool))
    toxicity._count_logits(frame.repartition(5), model)
    z, lang = toxicity._logits(model, words)
    for k in set(lang):  # as good as the best cut between any two rows, but for those of one cell
        best = [2 * y[(lang == k) & (z >= m.thresholds[k])].sum() / (((lang == k) & (z >= m.thresholds[k])).sum() + y[lang == k].sum()) for m in (model, want)]
        assert best[0] >= best[1] - 0.01


def test_every_row_is_drawn_and_every_shard_is_whole(monkeypatch):
    rng = np.random.default_rng(1)
    for rows, n in ((np.arange(100), 100), (np.arange(5, 42), 200), (np.array([3]), 7)):
        got = toxicity._shuffled(rows, n, rng)
        assert len(got) == n and set(got) == set(rows)
        assert np.bincount(got)[rows].max() - np.bincount(got)[rows].min() <= 1
    drawn = []
    monkeypatch.setattr(toxicity, "_step", lambda model, opt, tokens, labels: drawn.append((tokens, labels.tolist())))
    toxicity._passes(None, None, list(range(20_000)), np.array([float(i % 10 == 0) for i in range(20_000)]), rng)
    assert {i for tokens, _ in drawn for i in tokens} == set(range(20_000))
    assert all(sum(labels) == toxicity.BATCH / 2 == len(labels) / 2 for _, labels in drawn)

    import pyarrow as pa

    shard, toxic = [0] * 7 + [2] * 9 + [3], [i % 2 for i in range(17)]
    tokens = [np.full((i % 4, 3), i, np.uint16).tobytes() for i in range(17)]
    table = pa.table({"shard": pa.array(shard, pa.int32()), "toxic": pa.array(toxic, pa.int32()), "tokens": pa.array(tokens, pa.binary())})
    for limit in (1 << 20, 12, 0):  # one chunk, several, a text each
        monkeypatch.setattr(toxicity, "SHARD_BYTES", limit)
        got = []
        for s, chunks in toxicity._shards(iter(table.to_batches(max_chunksize=4))):
            for words, labels in chunks:
                assert sum(w.nbytes for w in words) <= 2 * limit or len([w for w in words if len(w)]) == 1
                got += [(s, int(y), w.tobytes()) for w, y in zip(words, labels)]
        assert got == list(zip(shard, toxic, tokens))
