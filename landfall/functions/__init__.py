"""Column functions: native Spark expressions only, no Python UDFs."""
