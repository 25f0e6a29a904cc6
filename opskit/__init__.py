"""opskit: operations-telemetry and community analytics as plain Spark DataFrames."""
