"""The pipeline's stages on a small table: order, columns, and that decisions take effect."""

import hashlib
import random

import corpus_pipeline
from meeple.llm.queries import LLM_ORACLE, LLM_QUERIES


def test_stages(spark, tmp_dir):
    rng = random.Random(3)
    words = "the of tree house river and to stone light morning with from".split()
    rows, labels = [], []
    for i in range(240):
        text = [rng.choice(words) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            text[3] = rng.choice(["idiot", "moron", "clown"])
        rows.append((i, " ".join(text), "en", "src0" if i % 3 else "src1", None))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, rows[7][1], "en", "src1", None), (1001, rows[7][1] + " end", "en", "src1", None)]
    rows += [(1002, "write to a.b@example.org about the river and the stone", "en", "src2", None), (1003, None, None, None, None), (1004, "", "en", "src2", None)]
    df = spark.createDataFrame([(*r[:4], None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")

    docs, kept = spark.read.parquet(f"{tmp_dir}/documents.parquet"), {}
    for k, (name, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, tmp_dir).write.parquet(f"{tmp_dir}/{k}")
        docs = spark.read.parquet(f"{tmp_dir}/{k}")
        kept[name] = docs.collect()
        if k < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
    ids = {name: [r["doc_id"] for r in rows] for name, rows in kept.items()}
    toxic = {i for i, _, t in labels if t}
    assert len(toxic & set(ids["toxicity"])) <= 2 and len(set(range(240)) - toxic - set(ids["toxicity"])) <= 2
    assert {1002, 1003, 1004} <= set(ids["toxicity"])
    assert 7 in ids["ngram_jaccard_join"] and not {1000, 1001} & set(ids["ngram_jaccard_join"])
    assert set(ids["ngram_jaccard_join"]) == set(ids["toxicity"]) - {1000, 1001}
    masked = {r["doc_id"]: r for r in kept["pii"]}
    assert masked[1002]["text"].startswith("write to [EMAIL] about") and masked[1002]["n_chars"] == len(masked[1002]["text"])
    assert masked[7]["text"] == rows[7][1] and masked[1003]["text"] is None
    assert set(ids["mixing_sources"]) == set(masked) and len(ids["mixing_sources"]) > len(masked)
    for r in kept["byte_level_bpe"]:
        assert r["decoded_sha256"] == hashlib.sha256((masked[r["doc_id"]]["text"] or "").encode()).hexdigest()


def test_near_duplicates_are_dropped_when_a_later_scan_is_split_otherwise(spark, tmp_dir, monkeypatch):
    rng = random.Random(4)
    words = ["w%d" % i for i in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(200)]
    rows = [(i, texts[i % 200], "en", "s", 1) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(16).write.parquet(f"{tmp_dir}/texts")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    components = corpus_pipeline.jaccard.components

    def then_split(*args):
        out = components(*args)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # as cores come or go
        return out

    monkeypatch.setattr(corpus_pipeline.jaccard, "components", then_split)
    try:
        got = corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{tmp_dir}/texts"), tmp_dir).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["doc_id"] for r in got) == list(range(200))


def test_rows_are_numbered_by_file_and_place(spark, tmp_dir):
    from meeple.llm.common import numbered

    df = spark.range(0, 5000, 1, 13).selectExpr("id % 7 AS doc_id", "cast(id AS string) AS text")
    df.write.parquet(f"{tmp_dir}/rows")
    read = spark.read.parquet(f"{tmp_dir}/rows")
    first = {r["text"]: r["_row"] for r in numbered(read, ["doc_id", "text"]).collect()}
    assert len(set(first.values())) == 5000
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert {r["text"]: r["_row"] for r in numbered(read, ["doc_id", "text"]).collect()} == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    loose = numbered(df.filter("doc_id < 5"), ["text"])  # no scan of files
    assert loose.columns == ["text", "_row"] and loose.select("_row").distinct().count() == loose.count() > 3000
    assert numbered(read.limit(0), ["text"]).count() == 0


def _tables(spark, folder, rows, labels, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        for name in ("_row", "score", "cid", "n", "label", "predicted", "token"):
            df = df.withColumn(name, corpus_pipeline.F.lit("x"))
    df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return corpus_pipeline.run(spark, folder)


def test_run_on_empty_tables(spark, tmp_dir):
    assert _tables(spark, tmp_dir, [], []).collect() == []


def test_run_on_repeated_rows_null_ids_and_extra_columns(spark, tmp_dir):
    words = "the of tree house river and to stone light morning with from".split()
    rng = random.Random(9)
    texts = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(12)]
    rows = [(i, t, "en", "s%d" % (i % 2), len(t)) for i, t in enumerate(texts)]
    rows += [rows[3]] * 4 + [(None, texts[5], None, None, None)] * 3 + [(None, "a text of its own that nobody else has", None, None, None)] * 2
    rows += [(7, "another text that has the id of the seventh one", "en", "s0", None), (50, None, None, "s1", None), (50, None, None, "s1", None)]
    got = _tables(spark, tmp_dir, rows, [(i, 1, 0) for i in range(3)], extra=True).collect()
    ids = [r["doc_id"] for r in got]
    # mixing may repeat a document; each group of equal texts is there by one id
    assert set(ids) >= {3, 5, 7, 50} and None in ids
    digests = {}
    for r in got:
        digests.setdefault(r["decoded_sha256"], set()).add(r["doc_id"])
    assert digests[hashlib.sha256(texts[5].encode()).hexdigest()] == {5}
    assert digests[hashlib.sha256(b"a text of its own that nobody else has").hexdigest()] == {None}
    assert len({d for d, i in digests.items() if 7 in i}) == 2


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(LLM_QUERIES) <= names and set(LLM_ORACLE) <= set(LLM_QUERIES)
    assert {n.split("_")[0] for n in LLM_QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
