"""Patient-flow analytics as composable Spark DataFrame operators."""
