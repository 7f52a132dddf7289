"""Column-expression helpers. All built-in Spark expressions; no Python UDFs."""
