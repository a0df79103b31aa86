"""fleetlake: machine-telemetry pipelines written as Spark DataFrame jobs."""
