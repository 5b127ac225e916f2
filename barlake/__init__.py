"""Price-bar lake: load, upsert and track month-partitioned bar tables on Spark."""
