"""Learning-log analytics as Spark DataFrame operators."""
