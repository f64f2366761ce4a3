"""Corpus operators for training-data pipelines: mixing, privacy, licences, language-model
scoring, toxicity, fingerprints, language identification, near-duplicates and tokenisation.

Every operator is a function of DataFrames. Nothing outside this package imports it.
"""
