"""clipwell: short-form content analytics as PySpark DataFrame operators."""
