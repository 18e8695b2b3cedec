"""Column expressions: calendar, scalar, moment and array helpers. No Python UDFs."""
