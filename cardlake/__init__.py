"""Card-fraud analytics on Spark: cleaning, ingest, reports, graph features, scoring and retrieval."""
