"""Trade and event analytics expressed as PySpark DataFrame operators."""
