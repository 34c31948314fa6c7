"""PySpark operators for consumer-price observations."""
