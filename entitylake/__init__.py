"""Search, shape and audit large tables of entities and documents on Spark."""
