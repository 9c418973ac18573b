"""Flight on-time analytics as composable Spark DataFrame transformations."""
