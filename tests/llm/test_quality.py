"""Operator 13: statistics and rules against plain versions, held-out accuracy, odd rows."""

import numpy as np

from meeple.llm import quality
from meeple.llm.quality import FEATURES, RuleModel, grow_rules, holds, lasso, statistics, train
from tests.conftest import SF_SMALL


def _plain(text):
    """The statistics of one text, by string methods."""
    words, lines = text.split(), [x for x in text.split("\n") if x]
    solid = [c for c in text if not c.isspace()]
    letters = [c for c in solid if c.isalpha()]
    marks = [c for c in solid if not c.isalpha() and not c.isdigit()]
    low = [w.lower() for w in words]
    pairs = list(zip(low, low[1:]))
    share = lambda a, b: a / b if b else 0.0
    return {
        "log_chars": np.log1p(len(text)), "log_words": np.log1p(len(words)), "word_length": share(len(solid), len(words)),
        "letter_share": share(len(letters), len(solid)), "upper_share": share(sum(c.isupper() for c in letters), len(letters)),
        "digit_share": share(sum(c.isdigit() for c in solid), len(solid)), "mark_share": share(len(marks), len(solid)),
        "stops_per_word": share(sum(c in quality.STOPS for c in text), len(words)),
        "lone_mark_share": share(sum(not any(c.isalnum() for c in w) for w in words), len(words)),
        "marked_end_share": share(sum(not w[-1].isalnum() and w[-1] not in quality.USUAL_ENDS for w in words), len(words)),
        "repeat_share": share(sum(a == b for a, b in pairs), len(words)), "distinct_words": share(len(set(low)), len(words)),
        "top_word_share": share(max(map(low.count, low), default=0), len(words)),
        "distinct_pairs": share(len(set(pairs)), len(words) - 1), "log_lines": np.log1p(len(lines)),
        "words_per_line": share(len(words), len(lines)),
        "repeated_line_share": share(sum(len(x) for i, x in enumerate(lines) if x in lines[:i]), len(text)),
    }


def test_statistics_equal_string_methods():
    texts = [
        "", " ", "\n\n", "one", "One two, TWO.\nOne two, TWO.\n\nthree | 4 5.5 & a#", "é É ß straße ñandú!! ###", "a a a a\nb\na a a a\nb\nb",
        "x " * 500, "word. " * 3 + "\n" + "tail%%% tail%%%",
    ]
    got = statistics(texts)
    for row, text in zip(got, texts):
        want = _plain(text)
        np.testing.assert_allclose(row, [want[c] for c in FEATURES], rtol=1e-12, err_msg=repr(text))
    # a text's statistics do not depend on its neighbours
    np.testing.assert_array_equal(got, np.concatenate([statistics([t]) for t in texts]))


def test_rules_are_paths_and_hold_where_they_say():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    y = ((x[:, 0] > 0.2) & (x[:, 1] <= 0.5)).astype(float)
    rules = grow_rules(x, y, trees=4)
    assert any({(j, above) for j, _, above in r} == {(0, True), (1, False)} for r in rules)
    matrix = holds(rules, x)
    for r, rule in enumerate(rules):
        assert len(rule) <= quality.DEPTH
        for i in range(0, 600, 37):
            assert matrix[i, r] == all((x[i, j] > t) == above for j, t, above in rule)
    model = train(x, y)
    assert ((model.logits(x) >= np.log(0.3 / 0.7)) == (y == 1)).mean() > 0.95


def test_lasso_meets_its_optimality_conditions():
    rng = np.random.default_rng(2)
    r = (rng.random((400, 12)) < 0.4).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(2 * r[:, 0] - 3 * r[:, 1])))).astype(float)
    penalty = 0.02
    w = lasso(r, y, penalty, steps=4000)
    slope = r.T @ (1 / (1 + np.exp(-(r @ w[:-1] + w[-1]))) - y) / len(y)
    on = np.abs(w[:-1]) > 1e-9
    np.testing.assert_allclose(slope[on], -penalty * np.sign(w[:-1][on]), atol=1e-6)
    assert (np.abs(slope[~on]) <= penalty + 1e-6).all()
    assert 0 < on.sum() < 12  # sparse


def test_spark_expression_equals_numpy(spark, docs):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["aa", "BB", "cc.", "##", "7", "x%"], size=n)) for n in rng.integers(0, 40, size=120)]
    x = statistics(texts)
    model = RuleModel([((2, 2.1, False), (6, 0.2, True)), ((11, 0.5, False),), ((0, 3.0, True), (4, 0.3, False))], [1.5, -0.75, 0.3], -0.2)
    rows = quality.classify(docs([(i, t) for i, t in enumerate(texts)]), model, ["doc_id"]).orderBy("doc_id").collect()
    want = 1 / (1 + np.exp(-model.logits(x)))
    np.testing.assert_allclose([r["score"] for r in rows], want, rtol=1e-12)
    assert [r["predicted"] for r in rows] == (want >= 0.3).astype(int).tolist()


def _prose(rng, n):
    return " ".join(rng.choice(["stone", "river", "The", "of", "tall", "house,", "wind.", "and", "field", "walks", "slow"], size=n))


def test_held_out_accuracy_and_odd_rows(spark, docs):
    rng = np.random.default_rng(4)
    good = [(i, _prose(rng, int(rng.integers(20, 200)))) for i in range(200)]
    bad = [(i, " ".join(["spam"] * int(rng.integers(20, 200))) if i % 2 else " ".join("W%d###" % k for k in rng.integers(0, 99, 60))) for i in range(200, 320)]
    odd = [(900, None), (901, ""), (902, _prose(rng, 200_000)), (None, "null id"), (0, good[0][1]), (0, "another text of this id")]
    labels = [(i, 1, None) for i, _ in good] + [(i, 0, 1) for i, _ in bad] + [(i, 0, 0) for i, _ in bad[:5]] + [(None, 1, 0), (901, None, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumnRenamed("toxic", "good")
    rows = quality.op13_quality(docs(good + bad + odd), table).collect()
    assert len(rows) == len(good + bad + odd)
    truth = {i: q for i, q, _ in labels if q is not None}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 30
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held if r["doc_id"]) / len(held) > 0.95
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[900]["score"] == by_id[901]["score"]
    assert by_id[902]["predicted"] == 1
    assert by_id[None]["held_out"] is False
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id long, quality int")
    table = docs([(i, f"text {i}") for i in range(8)])
    for labels in (none, one):
        rows = quality.op13_quality(table, labels).collect()
        assert len({r["score"] for r in rows}) == 1 and len(rows) == 8
    assert quality.op13_quality(docs([]), one).collect() == []


def test_a_repeated_document_does_not_fill_the_sample(spark, docs):
    rows = [(1, "same text here")] * 500 + [(i, f"word{i} and others.") for i in range(2, 40)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(1, 40)], "doc_id long, quality int")
    got = quality.op13_quality(docs(rows), labels)
    assert got.count() == len(rows)


def test_query_on_the_small_table(spark):
    read = lambda name: spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
    rows = quality.op13_quality(read("documents"), read("labels")).collect()
    assert len(rows) == read("documents").count()
    truth = {r["doc_id"]: r["quality"] for r in read("labels").collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.8
