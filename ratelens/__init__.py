"""Price-file analytics on Spark: ingest, normalise, compare and check charge rates."""
