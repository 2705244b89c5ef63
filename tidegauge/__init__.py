"""Market, news and documentation analytics as composable Spark DataFrame operators."""
