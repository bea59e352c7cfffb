"""Record quality and rating analytics as Spark DataFrame operators."""
