"""Fleet telemetry analytics and chat moderation as Spark DataFrame operators."""
