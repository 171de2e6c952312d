"""Column expressions, evaluated inside Spark's own expression engine."""
