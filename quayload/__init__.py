"""Table loads on Spark: plan, conform, check, size, pack, write and reconcile."""
