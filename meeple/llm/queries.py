"""The corpus operators as registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import corpus_pipeline
from meeple.llm import (
    bpe, clustering, embeddings, fingerprint, jaccard, language, licenses, mixing, negatives, pii, quality, scoring, toxicity,
)
from meeple.llm.common import table

LLM_QUERIES = {
    "op1_temperature_mix": lambda s, sf: mixing.op1_temperature_mix(table(s, sf, "documents")),
    "op2_pii": lambda s, sf: pii.op2_pii(table(s, sf, "documents")),
    "op3_license_scan": lambda s, sf: licenses.op3_license_scan(table(s, sf, "documents")),
    "op4_lm_score": lambda s, sf: scoring.op4_lm_score(table(s, sf, "documents")),
    "op5_toxicity": lambda s, sf: toxicity.op5_toxicity(table(s, sf, "documents"), table(s, sf, "labels")),
    "op6_fingerprint": lambda s, sf: fingerprint.op6_fingerprint(table(s, sf, "documents")),
    "op7_language_id": lambda s, sf: language.op7_language(table(s, sf, "documents")),
    "op8_ngram_jaccard": lambda s, sf: jaccard.op8_jaccard(table(s, sf, "documents")),
    "op9_byte_bpe": lambda s, sf: bpe.op9_bpe(table(s, sf, "documents")),
    "op10_embedding_dedup": lambda s, sf: embeddings.op10_embeddings(table(s, sf, "embeddings")),
    "op11_centroid_clusters": lambda s, sf: clustering.op11_clusters(table(s, sf, "embeddings")),
    "op12_hard_negatives": lambda s, sf: negatives.op12_negatives(table(s, sf, "embeddings")),
    "op13_rule_quality": lambda s, sf: quality.op13_quality(table(s, sf, "documents"), table(s, sf, "labels")),
    "pipeline": corpus_pipeline.run,
}

#: DuckDB SQL per query, where SQL can express it.
LLM_ORACLE: dict[str, str] = {
    "op11_centroid_clusters": clustering.ORACLE_SQL,
    "op12_hard_negatives": negatives.ORACLE_SQL,
}
