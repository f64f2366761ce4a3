"""meeple: player analytics for mobile games on Spark DataFrames.

Layers (each a pure function of DataFrames plus explicit dates):

* ``meeple.sources``   table contracts, readers, typed and CRM ingest, test-data adapters
* ``meeple.functions`` column expressions (durations, money, exact rounding, age brackets)
* ``meeple.operators`` reusable operators: top-k per group, sampling, table maintenance
* ``meeple.plans``     silver enrichment, gold summaries, segmentation, business questions
* ``meeple.streaming`` incremental (micro-batch) refresh of the daily gold table
"""

__version__ = "0.1.0"
