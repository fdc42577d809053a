"""Small-area statistics on Spark: estimates with margins of error, as composable DataFrame transforms."""
