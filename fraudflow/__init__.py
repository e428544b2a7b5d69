"""Card-transaction analytics on Spark: ingest, enrich, features, store, train, serve."""
