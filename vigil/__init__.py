"""vigil: server telemetry reports on Spark DataFrames."""
