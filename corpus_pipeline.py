"""A training-data pipeline over ``documents``: toxic documents go, one document of each group
of near-duplicates stays, personal data is masked, sources are mixed, texts become tokens.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; :func:`run` writes each result below the
shared folder and hands the reread table to the next stage. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.llm import bpe, jaccard, mixing, pii, toxicity
from meeple.llm.common import few_files, numbered, stage, table, unstage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (operator 5, trained on the labels of these documents) does
    not call toxic."""
    rows = docs.select(*COLUMNS)
    model = toxicity.fit(rows, table(spark, sf_dir, "labels"))
    return toxicity.classify(rows, model, COLUMNS).filter("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (smallest doc_id, then place in the table) of each group linked by
    5-word shingles at Jaccard 0.75 or more (operator 8). Texts without a word are no duplicates.

    Rows are told apart by a number made of their file and place in it, so that a repeated doc_id is
    no obstacle and no scan, however it is split, numbers them anew."""
    rows = numbered(docs, COLUMNS)
    groups = jaccard.components(rows.select("_row", "text"), "_row")
    chosen = (
        groups.join(rows.select("_row", "doc_id"), "_row").groupBy("component_id")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("first")).select(F.col("first._row").alias("_row"))
    )
    return few_files(rows.join(chosen, "_row", "left_semi").select(*COLUMNS))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data (operator 2) replaced by its kind in brackets."""
    rows = docs.select(*COLUMNS)
    return pii.redact(rows, pii.fit(rows))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the temperature mixture (operator 1) draws them: each one at least
    once, those of small sources up to twice."""
    rows = docs.select(*COLUMNS)
    return mixing.apply(rows, mixing.plan(rows)).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes (operator 9) of every row."""
    return bpe.digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing_sources", mix_sources),
    ("byte_level_bpe", tokenize),
]

#: Trained models, connected components and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        done = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        unstage(docs)  # but for the input table itself, which no stage has written
        docs = done
    return docs
