"""Table contracts, readers, ingest and the test-data adapters."""
