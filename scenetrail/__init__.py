"""Scene ingest, provenance and run-history analytics as Spark DataFrame operators."""
