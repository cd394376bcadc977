"""Card-transaction analytics as composable PySpark DataFrame operators."""
