"""Run-telemetry analytics on Spark DataFrames: contract checks, run reconstruction, Gold metrics and serving."""
