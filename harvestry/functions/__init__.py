"""Column functions: native expressions, with Arrow-batched UDFs where Spark has none."""
