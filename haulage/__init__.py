"""haulage: chunked, validated and restartable table extraction on Spark."""
