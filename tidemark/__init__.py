"""Developer-event marts as Spark DataFrame operators."""
