"""News-record analytics as Spark jobs: ingest, keyed store, edition, events, packs."""
