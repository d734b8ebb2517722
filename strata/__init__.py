"""strata: Spark-native table and stream operators for a layered ingest lake."""
