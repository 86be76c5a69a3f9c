"""obsflow: landed nested JSON to deduplicated tables and daily marts, on Spark."""
