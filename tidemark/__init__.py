"""Stream, telemetry and corpus analytics as Spark DataFrame operators."""
