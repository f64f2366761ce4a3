"""Query plans: silver enrichment, gold summaries, segmentation, business questions."""
