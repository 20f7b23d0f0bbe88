"""usagelens: developer-tool telemetry analytics on Spark DataFrames."""
