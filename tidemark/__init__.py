"""Model-lifecycle analytics as Spark DataFrame operators."""
