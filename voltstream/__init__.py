"""Plant-telemetry analytics as plain Spark DataFrame transforms."""

__version__ = "0.1.0"
