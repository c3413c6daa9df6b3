"""String-rewriting analytics as Spark DataFrame operators."""
