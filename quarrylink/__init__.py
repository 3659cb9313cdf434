"""quarrylink: Spark-first entity linking and corpus processing."""
