"""dqloom: a metadata-driven data-quality engine whose operators are Spark DataFrame and Column expressions."""
