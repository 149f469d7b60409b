"""veriloom: a Spark-first engine for document evidence and text-corpus work."""
