"""Moving-object telemetry analytics as plain Spark DataFrame functions."""
